import pytest

from pyspark.sql import functions as F
from shopgrain.operators.lookup import fits_broadcast, hot_keys, lookup, salted_join
from tests.helpers import sorted_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third without a key, copies among them."""
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500))
        .alias("k"),
        (F.col("id") % 7).alias("v"),
    )


@pytest.fixture(scope="module")
def words(spark):
    return spark.range(400).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"),
        F.col("id").alias("w"),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_join(spark, skewed, words, how):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        expected = sorted_rows(skewed.join(words, "k", how))
        assert sorted_rows(salted_join(skewed, words, ["k"], how)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted_rows(lookup(skewed, words, ["k"], how)) == expected
    assert sorted_rows(lookup(skewed, words, ["k"], how, max_rows=10)) == expected


def test_hot_rows_are_spread(spark, skewed, words):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = (
            salted_join(skewed, words, ["k"])
            .groupBy(F.spark_partition_id())
            .count()
            .agg(F.max("count"))
            .first()[0]
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sizes < 2000  # the hot key alone has 2000 rows


def test_hot_keys_are_the_frequent_ones(spark, skewed):
    hot = {r["_h"] for r in hot_keys(skewed, ["k"]).collect()}
    frequent = skewed.groupBy("k").count().where("count > 6").select(F.xxhash64("k").alias("h"))
    assert hot == {r.h for r in frequent.collect()}
    # A third of the rows gets a third of the salts.
    assert [r["_salts"] for r in hot_keys(skewed, ["k"]).collect()] == [11, 11]


def test_nothing_to_join(spark, skewed, words):
    assert hot_keys(skewed.where("v > 99"), ["k"]).count() == 0
    assert salted_join(skewed.where("v > 99"), words, ["k"]).count() == 0
    assert salted_join(skewed, words.where("w < 0"), ["k"]).count() == skewed.count()


def test_two_column_keys(spark):
    left = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (None, "a", 2)], "x int, y string, z int")
    right = spark.createDataFrame([(1, "a", "hit")], "x int, y string, w string")
    expected = [(1, "a", 0, "hit"), (1, "b", 1, None), (None, "a", 2, None)]
    got = salted_join(left, right, ["x", "y"]).select("x", "y", "z", "w")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == expected


def test_bounds_count_rows_and_bytes(spark, words):
    assert fits_broadcast(words)
    assert fits_broadcast(words, max_rows=400)
    assert not fits_broadcast(words, max_rows=399)
    assert not fits_broadcast(words, max_bytes=1000)
    assert fits_broadcast(words.where("false"))


def test_a_key_above_an_average_partition_is_found_with_many_partitions(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 1112 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k")
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        found = hot_keys(rows, ["k"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    hot = spark.range(1).select(F.xxhash64(F.lit(-1).cast("bigint")).alias("h")).first().h
    assert {r["_h"]: r["_salts"] for r in found}.get(hot, 0) >= 10  # 0.09 % of the rows


def test_the_right_side_is_worked_out_once(spark):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(x):
        runs.add(1)
        return x

    right = spark.range(50).select(counted("id").alias("k"), F.lit(1).alias("v"))
    left = spark.range(100).withColumnRenamed("id", "k")
    assert lookup(left, right, ["k"]).where("v = 1").count() == 50
    assert runs.value == 50
