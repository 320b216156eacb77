"""Approximate nearest neighbours by largest inner product, with balanced posting lists.

Vectors get one more component that gives all the norm of the longest, so that the largest inner product is the smallest
distance. Centroids come from a bounded sample by k-means with a penalty on full lists. They are linked to
their nearest centroids, and a best-first search of that graph, held in every worker, finds the lists of a vector: a
stored vector is replicated to the lists whose centroid is at most ``replica_ratio`` times as far as the nearest (so
those near a boundary stand on both sides), a query reads the lists within another ratio. Where the nearest is nearer
than a sampled vector's second nearest is in the median, as for a query on a centroid, that distance stands in for it.
The ratio for queries, and the most lists that one reads, are found on the sample: the least that cover a share of the sampled
queries' nearest. So how many lists are read follows from the vectors: few where they have clusters, many where they have
none. A query reads more lists only where these hold fewer rows than it wants. A list and its queries meet in blocks of bounded size, where
exact inner products give each query's best of the list; the bests of all lists are merged by query.

Of equal vectors only as many can be among a query's nearest as are asked for, plus itself, and ties go to smaller ids; so
the index keeps the smallest ids of each distinct vector, and equal queries are searched once. Both are exact and
keep a very common vector from filling a list.

Bounds: ``sample`` rows are fitted (``max_lists`` centroids at most, held on the driver and in workers); every row is
indexed.

Rows: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither do those whose length is
not the most frequent one; null ids neither. Repeated rows (same id, same vector) count once; one id with several vectors is a
candidate with each of them and listed once, by the nearest. Other input columns are left out, so no name can clash.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shopgrain.operators.lookup import salted_join
from shopgrain.sources.scratch import materialise

BLOCK = 2048  # rows of a list, and of its queries, that meet in one task
HASH_PLACES = 1 << 40
TIE = 1e-9  # inner products this near are compared exactly


@dataclass(frozen=True)
class Settings:
    neighbours: int = 20
    sample: int = 20_000
    max_lists: int = 65_536
    lists_per_root: float = 2.0  # lists = this times the root of the rows
    replicas: int = 3
    replica_ratio: float = 1.2
    count_covers: float = 0.97  # of the sampled queries' nearest, by the most lists that a query reads
    ratio_covers: float = 0.98  # of those, by the ratio
    sample_queries: int = 1024
    searched_least: int = 48  # lists that the graph search keeps in view, at least
    links: int = 24


class Centroids:
    """Centroids and the graph that finds the nearest of them."""

    def __init__(self, points: np.ndarray, links: int):
        self.points = points.astype(np.float32)
        self.norms = (self.points**2).sum(1)
        k = len(points)
        links = min(links, k - 1)
        self.links = np.empty((k, links), np.int32)
        for at in range(0, k, 1024):
            some = self._distances(self.points[at : at + 1024])
            some[np.arange(len(some)), np.arange(at, at + len(some))] = np.inf
            if links:
                nearest = np.argpartition(some, links - 1, axis=1)[:, :links]
                self.links[at : at + 1024] = nearest
        self.entries = np.unique(np.linspace(0, k - 1, min(k, 32)).astype(int))

    def _distances(self, vectors: np.ndarray) -> np.ndarray:
        return self.norms - 2 * vectors @ self.points.T

    def search(self, vectors: np.ndarray, width: int, grow: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """Lists and distances of each vector's ``width`` nearest centroids, nearest first.

        Best-first: each round opens the nearest unopened centroids in view and looks at their links, until all in view
        are open.
        """
        k, rows = len(self.points), len(vectors)
        width = min(width, k)
        vectors = vectors.astype(np.float32)
        own = (vectors**2).sum(1)
        seen = np.zeros((rows, k), bool)
        start = np.tile(self.entries, (rows, 1))
        seen[:, self.entries] = True
        view = np.full((rows, width + start.shape[1]), -1, np.int64)
        far = np.full(view.shape, np.inf, np.float32)
        view[:, : start.shape[1]] = start
        far[:, : start.shape[1]] = self._to(vectors, start)
        opened = far == np.inf
        while True:
            order = np.argsort(far, axis=1, kind="stable")[:, :width]
            view, far, opened = (np.take_along_axis(x, order, 1) for x in (view, far, opened))
            waiting = np.where(opened, np.inf, far)
            active = np.flatnonzero(np.isfinite(waiting).any(1))
            if not len(active) or not self.links.shape[1]:
                break
            take = min(grow, width)
            nearest = np.argpartition(waiting[active], take - 1, axis=1)[:, :take]
            valid = np.isfinite(np.take_along_axis(waiting[active], nearest, 1))
            opened[active[:, None], nearest] = True
            found = self.links[np.where(valid, view[active[:, None], nearest], 0)]
            found = np.where(valid[:, :, None], found, -1).reshape(len(active), -1)
            found.sort(axis=1)
            again = np.zeros(found.shape, bool)
            again[:, 1:] = found[:, 1:] == found[:, :-1]
            fresh = (found >= 0) & ~again
            fresh &= ~seen[active[:, None], np.maximum(found, 0)]
            seen[active[:, None], np.where(fresh, found, self.entries[0])] = True
            distance = np.where(fresh, self._to(vectors[active], np.maximum(found, 0)), np.inf)
            more = np.full((rows, found.shape[1]), np.inf, np.float32)
            ids = np.full((rows, found.shape[1]), -1, np.int64)
            more[active], ids[active] = distance, found
            view, far = np.hstack([view, ids]), np.hstack([far, more])
            opened = np.hstack([opened, np.isinf(more)])
        return view, np.sqrt(np.maximum(far + own[:, None], 0))

    def _to(self, vectors: np.ndarray, lists: np.ndarray) -> np.ndarray:
        return self.norms[lists] - 2 * np.einsum("rd,rld->rl", vectors, self.points[lists])


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """k-means on the sphere of the sample, whose distances grow with the members that a list has already."""
    radius = float(np.linalg.norm(sample[0]))
    rng = np.random.default_rng(seed)
    points = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    points = points.astype(np.float32)
    k = len(points)
    even = len(sample) / k
    for _ in range(rounds):
        load, sums = np.zeros(k), np.zeros_like(points)
        weight = None
        for rows in np.array_split(rng.permutation(len(sample)), max(1, len(sample) // 1024)):
            some = sample[rows]
            distance = (points**2).sum(1) - 2 * some @ points.T
            if weight is None:
                weight = 0.02 * float(np.mean(distance.max(1) - distance.min(1)))
            to = np.argmin(distance + weight * np.maximum(load / even - 1, 0), axis=1)
            load += np.bincount(to, minlength=k)
            np.add.at(sums, to, some)
        length = np.linalg.norm(sums, axis=1)
        filled = length > 0
        points[filled] = sums[filled] * (radius / length[filled, None])
        points[~filled] = sample[rng.choice(len(sample), int((~filled).sum()))]
    return points


def valid_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector of the rows that take part, repeated rows once."""
    vector = F.col(vector_column)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    kept = table.select(F.col(id_column).alias("id"), vector.alias("vector")).where(
        F.col(id_column).isNotNull() & vector.isNotNull() & ~bad & some
    )
    length = kept.groupBy(F.size("vector").alias("length")).count()
    usual = length.orderBy(F.desc("count"), "length").select("length").first()
    return kept.where(F.size("vector") == (usual["length"] if usual else 0)).distinct()


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v) for v in column])


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that gives them the norm ``longest``."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors.astype(np.float64) ** 2).sum(1), 0))
    return np.hstack([vectors, rest[:, None]]).astype(np.float32)


def _stretched(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Queries at the norm ``longest``, which changes no order of inner products."""
    wide = vectors.astype(np.float64)
    wide *= longest / np.linalg.norm(wide, axis=1, keepdims=True)
    return np.hstack([wide, np.zeros((len(wide), 1))]).astype(np.float32)


class Index(NamedTuple):
    """What is fitted on the sample: centroids, the longest norm, and how queries choose their lists."""

    centroids: Centroids
    longest: float
    ratio: float  # to the nearest list's distance
    usual: float  # stands in for a smaller distance
    most: int  # lists that a query reads

    def replicated(self, vectors: DataFrame, settings: Settings) -> DataFrame:
        """id, vector, list of stored rows."""
        lift = lambda m: _lifted(m, self.longest)
        return _in_lists(vectors, self.centroids, lift, settings.replicas, settings.replica_ratio)

    def searched(
        self, vectors: DataFrame, settings: Settings, sizes: np.ndarray, enough: int
    ) -> DataFrame:
        """id, vector, list of queries; ``sizes`` are the lists' rows, of which a query wants ``enough``."""
        stretch = lambda m: _stretched(m, self.longest)
        width = max(settings.searched_least, self.most)
        return _in_lists(
            vectors, self.centroids, stretch, width, self.ratio, self.usual, self.most, sizes, enough
        )


def fitted_index(sample: np.ndarray, rows: int, longest: float, settings: Settings) -> Index:
    """The index for ``rows`` vectors, of which ``sample`` holds some.

    The nearest within a sample are further away than those within all rows: of a sampled query as many are looked at as the sample
    has of the wanted ones on average, one at least.
    """
    lists = min(settings.max_lists, int(np.ceil(settings.lists_per_root * np.sqrt(rows))))
    lifted = _lifted(sample, longest)
    centroids = Centroids(balanced_centroids(lifted, lists), settings.links)
    second = [centroids.search(lifted[at : at + 512], 2)[1][:, -1] for at in range(0, min(len(lifted), 4096), 512)]
    usual = float(np.median(np.concatenate(second)))
    # in slices, as a search gathers the centroids that it looks at for every row
    slices = [centroids.search(lifted[at : at + 512], settings.replicas) for at in range(0, len(lifted), 512)]
    own, far = (np.concatenate(x) for x in zip(*slices))
    own = np.where((far <= far[:, :1] * settings.replica_ratio) & (own >= 0), own, own[:, :1])
    wanted = max(1, min(round(settings.neighbours * len(sample) / rows), len(sample) - 1))
    if len(sample) < 2:
        return Index(centroids, longest, 1.0, usual, 1)
    picked = np.random.default_rng(3).permutation(len(sample))[: settings.sample_queries]
    ranks, ratios = [], []
    wide = sample.astype(np.float64)
    for at in range(0, len(picked), 128):
        some = picked[at : at + 128]
        queries = _stretched(sample[some], longest)
        distance = centroids._distances(queries) + (queries**2).sum(1, keepdims=True)
        distance = np.sqrt(np.maximum(distance, 0))
        product = wide[some] @ wide.T
        product[np.arange(len(some)), some] = -np.inf
        best = np.argpartition(-product, wanted - 1, axis=1)[:, :wanted]
        row = np.arange(len(some))[:, None, None]
        ranks.append(distance.argsort(axis=1).argsort(axis=1)[row, own[best]].min(axis=2).ravel())
        nearest = np.maximum(distance.min(axis=1), usual)[:, None]
        reach = distance[row, own[best]].min(axis=2)
        ratios.append((reach / np.maximum(nearest, 1e-30)).ravel())
    rank, needed = np.concatenate(ranks), np.concatenate(ratios)
    most = int(np.ceil(np.quantile(rank, settings.count_covers))) + 1
    ratio = max(1.0, float(np.quantile(needed[rank < most], settings.ratio_covers)))
    return Index(centroids, longest, ratio, usual, most)


def _in_lists(
    vectors: DataFrame,
    centroids: Centroids,
    lift,
    width: int,
    ratio: float,
    least: float = 0.0,
    most: int | None = None,
    sizes: np.ndarray | None = None,
    enough: int = 0,
) -> DataFrame:
    """id, vector, list: a row for each list within ``ratio`` of the nearest, or of the distance ``least``, ``most`` at the most.

    The nearest list counts in any case, and, with the lists' sizes, as many as hold ``enough`` rows; where the lists in view
    hold less, all lists count.
    """
    kind = vectors.schema["vector"].dataType.simpleString()
    id_kind = vectors.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
                matrix = lift(flat.reshape(batch.num_rows, -1))
                lists, far = centroids.search(matrix, width)
                wanted = far <= np.maximum(far[:, :1], least) * ratio
                wanted[:, most or wanted.shape[1] :] = False
                wanted[:, 0] = True
                few = np.zeros(len(lists), bool)
                if sizes is not None:
                    held = np.where(lists >= 0, sizes[np.maximum(lists, 0)], 0).cumsum(axis=1)
                    wanted[:, 1:] |= held[:, :-1] < enough
                    few = held[:, -1] < enough
                row, col = np.nonzero(wanted & (lists >= 0) & ~few[:, None])
                every = np.arange(len(centroids.points))
                rows = np.concatenate([row, np.repeat(np.flatnonzero(few), len(every))])
                found = np.concatenate([lists[row, col], np.tile(every, few.sum())])
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(found, pa.int32())], ["id", "vector", "list"]
                )

    return vectors.mapInArrow(assign, f"id {id_kind}, vector {kind}, list int")


def _in_blocks(placed: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their block of the list, and the number of rows and blocks by list (a row per list)."""
    written = materialise(placed, name)
    blocks = written.groupBy("list").agg(
        F.count(F.lit(1)).alias(f"{name}_rows"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(f"{name}_blocks"),
    )
    dealt = written.join(F.broadcast(blocks), "list").withColumn(
        f"{name}_block", F.pmod(F.xxhash64("id"), F.col(f"{name}_blocks")).cast("int")
    )
    return dealt.drop(f"{name}_blocks", f"{name}_rows"), blocks


def _spread(dealt: DataFrame, blocks: DataFrame, name: str) -> DataFrame:
    """Each row once for every block of the other side; lists that the other side lacks drop out."""
    every = F.explode(F.sequence(F.lit(0), F.col(f"{name}_blocks") - 1)).alias(f"{name}_block")
    return dealt.join(F.broadcast(blocks), "list").select(*dealt.columns, every)


def nearest(
    table: DataFrame,
    queries: DataFrame,
    settings: Settings = Settings(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of ``table`` found for each row of ``queries``, never itself."""
    stored = materialise(valid_vectors(table, id_column, vector_column), "vectors")
    asked = materialise(valid_vectors(queries, id_column, vector_column), "queries")
    wanted = settings.neighbours + 1  # a query's own row may be among them
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    stats = stored.select(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("square"),
    ).first()
    if not stats["rows"]:
        return table.sparkSession.createDataFrame([], schema)
    copy = Window.partitionBy("vector").orderBy("id")
    distinct = stored.withColumn("copy", F.row_number().over(copy)).where(F.col("copy") <= wanted).drop("copy")
    longest = float(np.sqrt(stats["square"]))
    # the rows with the smallest hashes: a sample of bounded size, the same on every run; few more than it has are sorted
    share = min(1.0, 1.25 * settings.sample / stats["rows"])
    place = F.pmod(F.xxhash64("id"), F.lit(HASH_PLACES))
    near = stored.where(place < F.lit(int(np.ceil(share * HASH_PLACES))))
    sample = near.orderBy(place, "id", "vector").limit(settings.sample).select("vector")
    index = fitted_index(_matrix(r["vector"] for r in sample.collect()), stats["rows"], longest, settings)
    # rows are dealt out before each becomes a row per list, as AQE sees only their size before
    partitions = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    list_rows, list_blocks = _in_blocks(
        index.replicated(distinct.repartition(partitions, "id"), settings), "list"
    )
    sizes = np.zeros(len(index.centroids.points), np.int64)
    for row in list_blocks.collect():
        sizes[row["list"]] = row["list_rows"]
    keyed = materialise(asked.groupBy("vector").agg(F.min("id").alias("id")), "distinct-queries")
    dealt = keyed.select("id", "vector").repartition(partitions, "id")
    # a row is in so many lists at most
    query_rows, query_blocks = _in_blocks(
        index.searched(dealt, settings, sizes, settings.replicas * wanted), "query"
    )
    left = _spread(list_rows, query_blocks, "query")
    right = _spread(query_rows, list_blocks, "list")

    def score(postings: pd.DataFrame, searches: pd.DataFrame) -> pd.DataFrame:
        if not len(postings) or not len(searches):
            return pd.DataFrame({"query": [], "ids": [], "scores": []})
        ids = postings["id"].to_numpy()
        stored_vectors = _matrix(postings["vector"]).astype(np.float64)
        asked_vectors = _matrix(searches["vector"]).astype(np.float64)
        rough = asked_vectors @ stored_vectors.T
        most = min(wanted, len(ids))
        least = np.partition(rough, len(ids) - most, axis=1)[:, len(ids) - most]
        found_ids, found_scores = [], []
        for i in range(len(searches)):
            some = np.flatnonzero(rough[i] >= least[i] - TIE * longest**2)
            exact = (stored_vectors[some] * asked_vectors[i]).sum(axis=1)
            best = np.lexsort((ids[some], -exact))[:most]
            found_ids.append(ids[some[best]])
            found_scores.append(exact[best])
        return pd.DataFrame({"query": searches["id"], "ids": found_ids, "scores": found_scores})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate(group["ids"].tolist())
        scores = np.concatenate(group["scores"].tolist())
        order = np.lexsort((ids, -scores))
        first = np.unique(ids[order], return_index=True)[1]
        order = order[np.sort(first)][:wanted]
        return pd.DataFrame(
            {"query": group["query"].iloc[0], "id": ids[order], "score": scores[order]}
        )

    meet = ["list", "list_block", "query_block"]
    bests = (
        left.groupBy(*meet)
        .cogroup(right.groupBy(*meet))
        .applyInPandas(score, "query bigint, ids array<bigint>, scores array<double>")
    )
    merged = bests.groupBy("query").applyInPandas(merge, "query bigint, id bigint, score double")
    # queries with one very common vector are spread, as are their results
    members = materialise(
        salted_join(asked, keyed.withColumnRenamed("id", "query"), ["vector"], "inner").select(
            F.col("id").alias("query_id"), "query"
        ),
        "members",
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        salted_join(members, materialise(merged, "merged"), ["query"], "inner")
        .where("id <> query_id")
        .groupBy("query_id", "id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= settings.neighbours)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
