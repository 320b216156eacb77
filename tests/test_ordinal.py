import random

from pyspark.sql import functions as F
from shopgrain.operators.ordinal import with_ordinal, with_running_totals


def test_running_totals_over_sparse_page_numbers(spark):
    rng = random.Random(5)
    numbers = sorted(rng.sample(range(-10_000, 10**12), 800))
    rows = [(n, rng.randrange(5)) for n in numbers]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "page_no bigint, n bigint")
    totals = with_running_totals(df, "page_no", {"before": "n", "pages": F.lit(1)})
    total, expected = 0, []
    for i, (page_no, n) in enumerate(sorted(rows)):
        expected.append((page_no, n, total, i))
        total += n
    assert sorted(map(tuple, totals.collect())) == expected


def test_ordinal_with_a_hot_key_and_copies(spark):
    rng = random.Random(6)
    rows = [(1, 1, "copy")] * 300 + [(1, rng.randrange(50), str(i)) for i in range(300)]
    rows += [(rng.randrange(100), rng.randrange(50), str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "page bigint, pos bigint, x string").repartition(5)
    got = with_ordinal(df, ["page", "pos"]).orderBy("ord").collect()
    assert [r.ord for r in got] == list(range(1, 901))
    assert [(r.page, r.pos, r.x) for r in got] == sorted(rows)


def test_copies_do_not_fill_one_range(spark):
    df = spark.range(4000).repartition(8).select(F.lit(1).alias("k"))
    parts = []
    placed = with_ordinal(df, ["k"], partitions=8)
    parts = placed.agg(F.count(F.lit(1)), F.countDistinct("ord"), F.max("ord")).first()
    assert tuple(parts) == (4000, 4000, 4000)


def test_nothing_to_number(spark):
    assert with_ordinal(spark.range(0), ["id"]).count() == 0
    empty = spark.range(0).select(F.col("id").alias("p"), F.lit(1).alias("n"))
    assert with_running_totals(empty, "p", {"before": "n"}).count() == 0
