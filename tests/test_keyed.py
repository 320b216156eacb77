import random
from datetime import datetime

import pytest

from pyspark.sql import functions as F, types as T
from shopgrain.operators import keyed
from tests.helpers import sorted_rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "url string, ord bigint, x string")


def test_first_wins_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "hot", f"u{i % 40}"]), rng.randrange(100), str(i)) for i in range(900)]
    df = frame(spark, rows).repartition(7)
    best, copies = {}, {}
    for url, ord_, x in rows:
        best[url] = min(best.get(url, (ord_, x)), (ord_, x))
        copies[url] = copies.get(url, 0) + 1
    got = keyed.first_wins(df, ["url"], ["ord"], copies="n")
    assert got.columns == ["url", "ord", "x", "n"]
    assert {r.url: (r.ord, r.x) for r in got.collect()} == best
    assert {r.url: r.n for r in got.collect()} == copies


def test_first_wins_of_keys_alone(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    assert sorted_rows(keyed.first_wins(df, ["url"], [], copies="n")) == [("a", 2), ("b", 1)]


def test_usable_keys(spark):
    df = frame(spark, [("a", 1, ""), ("", 2, ""), (None, 3, "")])
    assert [r.url for r in keyed.usable_key(df).collect()] == ["a"]


def test_append_keeps_what_is_there(spark):
    target = frame(spark, [("a", 1, "old")])
    batch = frame(spark, [("a", 2, "new"), ("b", 4, "late"), ("b", 3, "early")])
    added = keyed.append_if_absent(target, batch, ["url"], ["ord"])
    assert sorted_rows(added) == [("b", 3, "early")]
    assert keyed.append_if_absent(target.union(added), batch, ["url"], ["ord"]).count() == 0
    assert sorted_rows(keyed.existing_rows(batch, target, ["url"])) == [("a", 2, "new")]


@pytest.mark.parametrize("small", [True, False])
def test_held_keys_cover_the_batch(spark, monkeypatch, small):
    monkeypatch.setattr(keyed, "small", lambda size: small)
    target = frame(spark, [(f"t{i}", i, "") for i in range(50)])
    batch = frame(spark, [("t3", 1, ""), ("n", 2, "")])
    held = keyed.held_keys(batch, target, ["url"])
    assert sorted_rows(keyed.new_rows(batch, held, ["url"])) == [("n", 2, "")]
    assert held.count() == (1 if small else 50)


def test_upsert(spark):
    schema = "id bigint, category string, n bigint"
    target = spark.createDataFrame([(1, "keep", 1), (2, "change", 2)], schema)
    batch = spark.createDataFrame([(8, "change", 20), (9, "new", 30), (10, None, 40)], schema)
    got = keyed.upsert(target, batch, "category", ["n"])
    assert sorted_rows(got) == [(1, "keep", 1), (2, "change", 20), (9, "new", 30)]
    # A null in the batch replaces a value.
    gone = spark.createDataFrame([(8, "change", None)], schema)
    assert (2, "change", None) in sorted_rows(keyed.upsert(target, gone, "category", ["n"]))


def test_old_parts_gain_new_columns(spark):
    schema = T.StructType(
        [T.StructField("a", T.StringType()), T.StructField("b", T.LongType()),
         T.StructField("at", T.TimestampType())]
    )
    old = spark.range(1).select(F.lit("x").alias("a"))
    new = spark.createDataFrame([(7, "y", "extra", datetime(2024, 1, 1))], "b int, a string, z string, at timestamp")
    got = keyed.evolve_union([old, new], schema)
    assert got.schema == schema
    assert sorted_rows(got) == [("x", None, None), ("y", 7, datetime(2024, 1, 1))]
