import re

import pytest

from shopgrain.llm import mixing
from tests.llm.helpers import ROWS, documents, each_case, plan_of, plans_of


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_by_hand(sizes, weights=(5, 2, 1), cap=3):
    """Targets of sources given as {source: size}: the excess over the cap is shared again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    open_, left, out = set(sizes), sum(sizes.values()), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            open_.remove(s)
        left -= sum(out[s] for s in over)
    return out


def check(rows, found, tolerance):
    source = {}
    sizes = {}
    for doc, text, _, s, _ in rows:
        source[doc] = s
        sizes[s] = sizes.get(s, 0) + words(text)
    targets = targets_by_hand(sizes)
    taken = dict.fromkeys(sizes, 0)
    assert len(found) == len(rows)
    for r in found:
        s = source[r.doc_id]
        assert (r.source_size, r.target) == (sizes[s], pytest.approx(targets[s]))
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies and 0 <= r.rate <= 3
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= tolerance(s, targets[s]), (s, taken[s], targets[s])


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    found = mixing.mix(docs).collect()
    assert sorted(found) == sorted(mixing.mix(docs.repartition(3)).collect())  # reruns agree
    check(rows, found, lambda s, target: 0.05 * target)
    sizes = {r[0]: words(r[1]) for r in rows}
    assert {r.doc_id: r.size for r in found} == sizes


def test_many_documents_come_very_near(spark):
    rows = [(i, "w " * (1 + i * 7919 % 97), "en", f"s{i % 5}" if i % 3 else "hot", 1) for i in range(6000)]
    check(rows, mixing.mix(documents(spark, rows)).collect(), lambda s, target: 3)


def test_rates_are_the_dual_s_solution(spark):
    """Within a source the log of a rate below the cap is proportional to the size."""
    import math

    rows = [(i, "w " * (1 + i % 50), "en", "ab"[i % 2], 1) for i in range(800)]
    found = mixing.mix(documents(spark, rows)).collect()
    for s in (0, 1):
        slopes = {round(math.log(r.rate) / r.size, 9) for r in found if r.doc_id % 2 == s and r.rate < 3}
        assert len(slopes) == 1
        ideal = sum(r.rate * r.size for r in found if r.doc_id % 2 == s)
        assert ideal == pytest.approx(next(r.target for r in found if r.doc_id % 2 == s), rel=1e-6)


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1, 1000], [5, 0, 0], [0, 0], [3], [2, 90, 1, 7, 7, 7]])
def test_targets(spark, sizes):
    rows = [(i, "w " * n, "en", f"s{i}", 1) for i, n in enumerate(sizes)]
    found = mixing.mix(documents(spark, rows)).collect()
    expected = targets_by_hand({f"s{i}": n for i, n in enumerate(sizes)})
    assert {f"s{r.doc_id}": pytest.approx(r.target) for r in found} == expected


def test_awkward_rows(spark):
    found = each_case(spark, mixing.mix).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in found) == sorted(
        (i is None, i or 0, words(t)) for i, t, *_ in ROWS
    )
    assert all(r.taken <= 3 * r.size for r in found)


def test_documents_are_repeated_with_their_columns(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 9), "en", f"s{i % 3}", i) for i in range(300)])
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    seen = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert seen == {d: n for d, n in copies.items() if n}
    assert mixing.mixed_documents(documents(spark, [])).collect() == []


def test_rates_and_rules_are_broadcast_by_their_counted_size(spark, monkeypatch):
    docs = documents(spark, [(i, "word " * (i % 1500), "en", f"s{i % 7}", 1) for i in range(3000)])
    expected = sorted(r.doc_id for r in mixing.mixed_documents(docs).collect())
    with plans_of(spark, monkeypatch, mixing, "200k") as plans:  # of 500 KB in files of 100
        monkeypatch.setattr(mixing, "small", lambda size: False)
        mixed = mixing.mixed_documents(docs)
        last = plan_of(mixed)
        assert sorted(r.doc_id for r in mixed.collect()) == expected
    for plan in (plans["places"][0], last):
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in plans["cells"][0]  # seven sources
