import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shopgrain.llm import merkle
from tests.llm.helpers import ROWS, documents, each_case, rows_of


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    i, _, lang, source, n = row
    return digest("".join(map(field, (i, source, lang, n, text))))


def climb(nodes, fanout):
    """All levels over ``nodes``, up to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[k : k + fanout])) for k in range(0, len(last), fanout)])
    return levels


def siblings(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        first = at - at % fanout
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + fanout])))
        at //= fanout
    return out


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows, fanout):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[3]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])], fanout) for s in names}
    top = climb([trees[s][-1][0] for s in names], fanout)
    root = top[-1][0]
    out = []
    for place, s in enumerate(names):
        for at, (_, _, own, row) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            path = siblings(trees[s], at, fanout) + siblings(top, place, fanout)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf(row, lowered(row[1])) if tampered else own
            for left, right in path:
                folded = digest(left + folded + right)
            proof = digest("".join(left + right for left, right in path))
            out.append((row[0], own, trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def test_awkward_rows(spark):
    assert rows_of(each_case(spark, merkle.verified_documents)) == expected(ROWS, 16)


def made(n, sources, seed=0):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    return [(i, f"Text {i} É", "en", rng.choice(sources), i % 7) for i in ids]


@pytest.mark.parametrize(
    "fanout, stride, n, sources",
    [
        (16, 2, 1, ["a"]),
        (16, 2, 700, ["a"]),
        (2, 2, 33, ["a", "b", None]),
        (2, 3, 100, [None, "", "a", "B", "é"]),
        (2, 1, 17, ["a", "b"]),
        (3, 2, 82, ["one"] * 9 + ["two"]),
    ],
)
def test_trees_of_all_heights(spark, fanout, stride, n, sources):
    """Sources of one row, of full runs and just over, heights above and below the written levels."""
    rows = made(n, sources)
    got = merkle.verified_documents(documents(spark, rows), fanout=fanout, stride=stride)
    assert rows_of(got) == expected(rows, fanout)


def test_many_sources_of_few_rows(spark):
    rows = made(300, [f"s{k}" for k in range(90)], seed=4)
    got = merkle.verified_documents(documents(spark, rows), fanout=4, stride=2)
    assert rows_of(got) == expected(rows, 4)


def test_only_tampered_rows_fail(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = merkle.verified_documents(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in got:
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and lowered(r.text) != r.text
        assert r.verified == (not changed)
    assert {r.verified for r in got} == {True, False}


def test_only_every_few_levels_are_written(spark):
    """Of five levels over 300 leaves three are written, and a written row holds a whole subtree, no interior node."""
    leaves = documents(spark, made(300, ["a"])).select(
        F.col("doc_id").alias("id"), F.col("source"), F.sha2("text", 256).alias("digest")
    )
    trees = merkle.manifest(leaves, [], fanout=4, stride=2).sources
    assert [level.count() for level in trees.levels] == [19, 2, 1]
    assert [max(len(r.nodes) for r in level.collect()) for level in trees.levels] == [16, 16, 2]
