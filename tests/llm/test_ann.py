import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import ann
from shopgrain.llm.ann import Centroids, Settings, balanced_centroids

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(vectors, queries, k):
    """Nearest by inner product among {id: vector}, ties to the smaller id."""
    ids = np.array(sorted(vectors))
    matrix = np.stack([vectors[i] for i in ids]).astype(np.float64)
    out = {}
    for q in queries:
        scores = (matrix * matrix[np.searchsorted(ids, q)]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found_in(spark, rows, every=1, settings=Settings(), extra=False):
    table = spark.createDataFrame(rows, SCHEMA)
    if extra:
        names = ("id", "vector", "list", "score", "rank", "query", "label")
        table = table.select("*", *[F.lit("x").alias(c) for c in names])
    out = {}
    for r in ann.nearest(table, table.where(f"vec_id % {every} = 0"), settings).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for rows_of in out.values():
        assert [r[0] for r in rows_of] == list(range(1, len(rows_of) + 1))
    return {q: [r[1:] for r in rows_of] for q, rows_of in out.items()}


def random_rows(n, d, seed, scale=None):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, d)).astype(np.float32)
    if scale is not None:
        points *= rng.uniform(*scale, size=(n, 1)).astype(np.float32)
    return [(i, p.tolist()) for i, p in enumerate(points)]


def recall(found, truth):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in truth[q]}) for q in truth)
    return hits / sum(len(t) for t in truth.values())


@pytest.mark.parametrize("scale", [None, (0.2, 3.0)])
def test_recall_and_exact_scores(spark, scale):
    rows = random_rows(1500, 32, 1, scale)
    vectors = {i: np.array(v, np.float32) for i, v in rows}
    found = found_in(spark, rows, every=15)
    truth = brute(vectors, [i for i in vectors if i % 15 == 0], 20)
    assert recall(found, truth) >= 0.9
    for q, near in found.items():
        assert len(near) == 20 and q not in {i for i, _ in near}
        for i, score in near:
            assert score == pytest.approx(math.fsum(np.float64(a) * b for a, b in zip(vectors[q], vectors[i])), abs=1e-12)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def test_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, np.float32) for r in table.collect()}
    out = {}
    for r in ann.nearest(table, table.where("vec_id % 20 = 0")).collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall(out, brute(vectors, [i for i in vectors if i % 20 == 0], 20)) >= 0.9


def test_a_very_common_vector(spark):
    """Equal vectors tie, and of them the smallest ids come first; the query itself is not among them."""
    rows = [(i, [1.0, 0.0, 0.0]) if i % 3 else (i, [0.5, i / 3000, 0.1]) for i in range(3000)]
    found = found_in(spark, rows, every=10)
    truth = brute({i: np.array(v, np.float32) for i, v in rows}, list(found), 20)
    hot = [q for q in found if q % 3]
    assert hot and all([i for i, _ in found[q]] == [i for i, _ in truth[q]] for q in hot)


def test_few_candidates(spark):
    found = found_in(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])])
    assert {q: [i for i, _ in near] for q, near in found.items()} == {0: [2, 1], 1: [2, 0], 2: [0, 1]}
    assert found_in(spark, [(0, [1.0, 0.0])]) == {}
    assert found_in(spark, []) == {}


def test_vectors_that_take_no_part(spark):
    good = [(i, [float(i), 1.0]) for i in range(1, 6)]
    bad = [(10, None), (11, []), (12, [0.0, 0.0]), (13, [None, 1.0]), (14, [float("nan"), 1.0]),
           (15, [float("inf"), 1.0]), (16, [1.0]), (None, [1.0, 2.0])]
    expected = found_in(spark, good)
    assert found_in(spark, good + bad) == expected
    assert found_in(spark, good + good) == expected  # repeated rows count once
    assert found_in(spark, good, extra=True) == expected


def test_blocks_of_lists_and_queries(spark, monkeypatch):
    rows = random_rows(600, 16, 4)
    whole = found_in(spark, rows, every=2)
    monkeypatch.setattr(ann, "BLOCK", 20)
    assert found_in(spark, rows, every=2) == whole


@pytest.mark.parametrize("k", [1, 2, 30, 400])
def test_the_graph_finds_the_nearest_centroids(k):
    rng = np.random.default_rng(k)
    points = rng.normal(size=(k, 24)).astype(np.float32)
    queries = rng.normal(size=(60, 24)).astype(np.float32)
    lists, far = Centroids(points, 24).search(queries, 48)
    true = np.linalg.norm(queries[:, None] - points[None], axis=2)
    assert np.allclose(np.take_along_axis(true, lists, 1), far, atol=1e-3)
    wanted = np.argsort(true, axis=1)[:, :8]
    hits = np.mean([len(set(a[:8]) & set(b)) / len(b) for a, b in zip(lists, wanted)])
    assert hits > 0.97


def test_lists_are_balanced():
    rng = np.random.default_rng(0)
    sample = rng.normal(size=(4000, 8)).astype(np.float32)
    sample[:1500] = sample[0] + 0.05 * sample[:1500]
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    centroids = balanced_centroids(sample, 50)
    sizes = np.bincount(np.argmax(sample @ centroids.T, axis=1), minlength=50)
    assert len(centroids) == 50 and sizes.max() < 1500


def test_an_id_with_several_vectors_is_listed_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 1.0]), (1, [1.0, 3.0]), (2, [0.5, 0.5])]
    found = found_in(spark, rows)
    assert found[0] == [(1, 3.0), (2, 0.5)]
    assert sorted(i for i, _ in found[1]) == [0, 2]


def clustered(n, d=32, seed=5):
    """As many clusters as the root of the rows, or nearly."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(int(n**0.5), d))
    return (centres[np.arange(n) % len(centres)] + 0.15 * rng.normal(size=(n, d))).astype(np.float32)


def share_scored(vectors, every=20):
    """Pairs of a query and a stored copy that meet in a list, of all pairs; and the recall of the lists."""
    n = len(vectors)
    longest = float(np.linalg.norm(vectors.astype(np.float64), axis=1).max())
    settings = Settings()
    sample = vectors[np.random.default_rng(1).permutation(n)[: settings.sample]]
    index = ann.fitted_index(sample, n, longest, settings)
    own, far = index.centroids.search(ann._lifted(vectors, longest), settings.replicas)
    own = np.where((far <= far[:, :1] * settings.replica_ratio) & (own >= 0), own, -1)
    sizes = np.bincount(own[own >= 0], minlength=len(index.centroids.points))
    queries = np.arange(0, n, every)
    pairs, hits, wanted = 0, 0, 0
    for at in range(0, len(queries), 200):
        some = queries[at : at + 200]
        width = max(settings.searched_least, index.most)
        lists, far = index.centroids.search(ann._stretched(vectors[some], longest), width)
        read = (far <= np.maximum(far[:, :1], index.usual) * index.ratio) & (lists >= 0)
        read[:, index.most :] = False
        read[:, 0] = True
        products = vectors[some].astype(np.float64) @ vectors.T
        products[np.arange(len(some)), some] = -np.inf
        best = np.argpartition(-products, 19, axis=1)[:, :20]
        for i in range(len(some)):
            mine = lists[i][read[i]]
            pairs += sizes[mine].sum()
            hits += np.isin(own[best[i]], mine).any(axis=1).sum()
            wanted += 20
    return pairs / (len(queries) * n), hits / wanted


def test_on_clustered_vectors_few_pairs_are_scored():
    """Lists are read by what the sample shows, not by a share of them."""
    shares, recalls = zip(*(share_scored(clustered(n)) for n in (2000, 8000, 32_000)))
    assert min(recalls) >= 0.9 and max(shares) < 0.1


def test_clustered_vectors(spark):
    vectors = clustered(3000)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = found_in(spark, rows, every=20)
    truth = brute(dict(enumerate(vectors)), [i for i in range(0, 3000, 20)], 20)
    assert recall(found, truth) >= 0.9
