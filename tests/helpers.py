"""Small helpers for the tests."""

import random

from pyspark.sql import types as T

ALPHABET = (
    "abcXYZ019_-/:?*[]\\ \t\n\r\x0b\x0c\x1c\x1f\x85\xa0   　"
    "éÉßİKçñ£€,.%&'\"()😀日本"
)


def strings_frame(spark, values):
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("x", T.StringType())])
    return spark.createDataFrame(list(enumerate(values)), schema)


def apply(spark, values, expr):
    """``expr(column x)`` of each value, in order."""
    rows = strings_frame(spark, values).select("i", expr("x").alias("y")).collect()
    return [r.y for r in sorted(rows, key=lambda r: r.i)]


def random_strings(n, seed=1, longest=50):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(longest))) for _ in range(n)]


def sorted_rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
