import random
from collections import defaultdict

import numpy as np
import pytest

from shopgrain.llm import components as graph, near_dedup
from shopgrain.llm.components import components
from tests.llm.helpers import documents, each_case, plan_of, plans_of


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def smallest_linked(texts):
    """Brute force: by document the smallest one that links reach."""
    sets = {d: shingles(t) for d, t in texts.items()}
    holders, root = defaultdict(list), {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d in sorted(sets):
        shared = defaultdict(int)
        for s in sets[d]:
            for other in holders[s]:
                shared[other] += 1
            holders[s].append(d)
        for other, n in shared.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[other]) - n):
                a, b = find(d), find(other)
                root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in texts}


def found_in(spark, texts):
    docs = documents(spark, [(d, t, "en", "a", 1) for d, t in texts.items()])
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(texts)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}


def family(rng, base, edits, size, first):
    """Copies of a text with some words changed, and copies of those copies."""
    out = {first: base}
    for k in range(1, size):
        words = rng.choice(list(out.values())).split()
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out[first + k] = " ".join(words)
    return out


@pytest.mark.parametrize("length, edits", [(8, 1), (40, 1), (120, 4), (600, 12)])
def test_families_of_near_copies(spark, length, edits):
    rng = random.Random(length)
    texts = {}
    for k in range(6):
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(length))
        texts |= family(rng, base, edits, 60, 1000 * (k + 1))
    assert found_in(spark, texts) == smallest_linked(texts)


def test_short_texts_around_one_passage(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {
        i: passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 90)))
        for i in range(400)
    }
    assert found_in(spark, texts) == smallest_linked(texts)


def test_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "PIVOT_ROUNDS", 1)
    rng = random.Random(9)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(100))
    texts = family(rng, base, 5, 150, 10)
    assert found_in(spark, texts) == smallest_linked(texts)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = near_dedup.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == smallest_linked(texts)


def test_awkward_rows(spark):
    found = each_case(spark, near_dedup.near_duplicates).collect()
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found}
    assert len(found) == 10
    assert {(5, 8, 1, False), (1, 8, 1, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True)} <= rows
    assert [r for r in found if r.doc_id == 3] == [(3, 1, 3, True)] * 2
    assert (None, 4, None, True) in rows


def test_one_of_each_keeps_columns_and_one_row_of_an_id(spark):
    kept = near_dedup.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(
        map(repr, [1, 7, 8, 9, 3, None, 12, 13])
    )
    assert near_dedup.one_of_each(documents(spark, [])).collect() == []


def test_one_of_each_tells_rows_of_an_id_apart(spark):
    one, other, third = (" ".join(f"{c}{i}" for i in range(20)) for c in "abc")
    rows = [(1, one), (2, one), (2, other), (2, other + " more"), (3, third), (3, third), (3, ""), (4, ""), (4, " ")]
    docs = documents(spark, [(d, t, "en", "a", i) for i, (d, t) in enumerate(rows)])
    kept = sorted((r.doc_id, r.text) for r in near_dedup.one_of_each(docs).collect())
    assert [(d, t) for d, t in kept if t.strip()] in (
        [(1, one), (2, other), (3, third)], [(1, one), (2, other + " more"), (3, third)]
    )
    assert [d for d, t in kept if not t.strip()] == [3, 4]


def test_one_of_each_of_rows_without_an_id(spark):
    one, other, third = (" ".join(f"{c}{i}" for i in range(20)) for c in "abc")
    texts = [one, one, one + " more", other, third + " more", "", "", None]
    docs = documents(spark, [(None, t, "en", "a", 1) for t in texts] + [(7, third, "en", "a", 1)])
    kept = [(r.doc_id, r.text) for r in near_dedup.one_of_each(docs).collect()]
    assert len(kept) == 6 and (7, third) in kept and (None, other) in kept
    assert sum((t or "").startswith("a0 ") for _, t in kept) == 1
    assert [t for d, t in kept if d is None and not t] in (["", "", None], ["", None, ""], [None, "", ""])


def test_a_hash_of_the_set_decides_and_not_the_order(spark):
    text = "a b c d e a b c d e a b c d e"
    assert found_in(spark, {1: text, 2: text + " a b c d e"})[2][1] == 1


@pytest.mark.parametrize("size", [1, 4, 60, 400, 3000])
def test_registers_agree_as_often_as_sets(size):
    rng = np.random.default_rng(size)
    equal, truth = [], []
    for _ in range(60):
        pool = rng.integers(0, 1 << 64, size * 2, dtype=np.uint64)
        one, other = np.unique(pool[:size]), np.unique(pool[size // 4 : size // 4 + size])
        a, b = near_dedup.registers(one), near_dedup.registers(other)
        estimate = near_dedup.estimate(
            np.array([(a == b).sum()]), np.array([len(one)]), np.array([len(other)])
        )
        equal.append(estimate[0])
        shared = len(np.intersect1d(one, other))
        truth.append(shared / (len(one) + len(other) - shared))
    assert abs(np.mean(equal) - np.mean(truth)) < 0.06


def test_chance_collisions_are_taken_off():
    assert 0 < near_dedup._chance(70, 70) < 4 / (1 << near_dedup.MANTISSA)
    rng = np.random.default_rng(1)
    agreed = []
    for _ in range(400):
        a, b = (np.unique(rng.integers(0, 1 << 64, 2000, dtype=np.uint64)) for _ in range(2))
        agreed.append((near_dedup.registers(a) == near_dedup.registers(b)).mean())
    assert np.mean(agreed) == pytest.approx(near_dedup._chance(76, 76), rel=0.6)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)]
    edges += [(200, 201), (201, 202), (202, 200), (300, 300), (40, 39), (40, 39)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.component for r in components(df).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in range(5, 41)} == {5}
    assert (found[202], found[300], len(found)) == (200, 300, 61 + 36 + 3 + 1)
    assert components(df.where("a < 0")).collect() == []


def near_copies(n, ids):
    """Texts of which each is linked with many others."""
    rng = random.Random(n)
    base = [f"w{rng.randrange(5000)}" for _ in range(80)]
    rows = []
    for i in range(n):
        words = list(base)
        words[rng.randrange(80)] = f"new{i}"
        rows.append((ids(i), " ".join(words), "en", "a", 1))
    return rows


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i], ids=["null", "one", "own"])
def test_ids_do_not_gather_texts(spark, ids, monkeypatch):
    """Whatever the ids are, the join that fetches the texts gives one row for each set."""
    n, fetched = 2000, []
    whole = near_dedup.lookup

    def counted(left, right, on, how="left", **more):
        joined = whole(left, right, on, how, **more)
        if "set_key" in right.columns:
            fetched.append(joined.count())
        return joined

    monkeypatch.setattr(near_dedup, "lookup", counted)
    docs = documents(spark, near_copies(n, ids))
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == n and {r.component_id for r in found} == {ids(0)}
    assert fetched == [n]
    assert near_dedup.one_of_each(docs).count() == 1


def test_rows_that_come_more_than_once(spark):
    rows = near_copies(40, lambda i: i % 10 if i % 3 else None)
    found = near_dedup.near_duplicates(documents(spark, rows * 5)).collect()
    assert len(found) == 200 and {r.component_id for r in found} == {min(i % 10 for i in range(40) if i % 3)}


def test_exploded_bands_are_not_broadcast_by_the_size_of_the_files(spark, monkeypatch):
    """Bands of these sets take 1.5 MB in memory, 32 times what Spark takes them for."""
    docs = documents(spark, near_copies(2000, lambda i: i))
    with plans_of(spark, monkeypatch, near_dedup, "256k") as plans:
        left = near_dedup.one_of_each(docs)
        last = plan_of(left)
    assert "BroadcastHashJoin" not in plans["bands"][0] and "SortMergeJoin" in plans["bands"][0]
    assert "BroadcastHashJoin" in last  # one row is kept
    assert [r.doc_id for r in left.collect()] == [0]


def test_sides_of_joins_are_broadcast_by_their_counted_size(spark, monkeypatch):
    edges = [(i // 2, i) for i in range(1, 4000)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    kinds = ["SortMergeJoin", "BroadcastHashJoin"]
    for threshold, (used, other) in (("128k", kinds), ("2m", kinds[::-1])):
        with plans_of(spark, monkeypatch, graph, threshold) as plans:
            found = components(df).collect()
        assert {r.component for r in found} == {0} and len(found) == 4000
        first = plans["roots"][0]
        assert used in first and other not in first
