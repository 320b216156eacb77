"""Equi-join against a table that is unique on the key, safe for hot keys on the left."""

from pyspark.sql import DataFrame, functions as F

from shopgrain.sources.scratch import Size, materialise, measured, size_columns

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20

HOT_SHARE = 0.001  # of the rows, or an average shuffle partition if that is less
TRACKED_PER_PARTITION = 8
LEAST_TRACKED, MOST_TRACKED = 8192, 1_000_000
MERGE_GROUPS = 512
SALTS_PER_PARTITION = 4


def small(size: Size, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    return size.rows <= max_rows and size.width <= max_bytes


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df`` with one distributed aggregate and compare with the bounds."""
    return small(Size(*df.agg(*size_columns(df)).first()), max_rows, max_bytes)


def by_merge(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles both sides, whatever Spark takes their sizes for."""
    return df.hint("merge")


def by_size(df: DataFrame, size: Size) -> DataFrame:
    """``df`` of a counted size as the right side of a join: broadcast within the session's
    ``spark.sql.autoBroadcastJoinThreshold``, else merged.

    Left to itself, Spark holds compressed files, the usual length of a text and one item of an array
    against the threshold, and the rows before an explode.
    """
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(df) if size.width <= most else by_merge(df)


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    measure: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``on``).

    A right side measured to be small is broadcast, so the left is not shuffled. Otherwise both
    sides shuffle on the key plus a salt that is non-zero only for hot keys: no task gets more
    than its share, and only the few hot right rows are copied. The right side is worked out once, into a
    written table whose size is counted on the way; with ``measure``, a table no smaller that is cheap to read twice
    as the right side is too, it is not written. The left's columns come first, in their order.
    """
    if measure is None:
        right, size = measured(right, "lookup")
        fits = small(size, max_rows, max_bytes)
    else:
        fits = fits_broadcast(measure, max_rows, max_bytes)
    if fits:
        joined = left.join(F.broadcast(right), on, how)
    else:
        joined = salted_join(left, right, on, how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on]
    return joined.select(*left.columns, *added)


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Shuffle join with each hot left key spread by its share of the rows; exact for any input.

    The left's key columns are read once more for the sketch.
    """
    # Written once, because both sides must see the same salts and a sketch may vary between runs.
    hot = F.broadcast(materialise(hot_keys(left, on), "hot-keys"))
    key_hash = F.xxhash64(*on)

    # Row copies hash alike, so the partition they come from takes part in the salt.
    spread = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.col("_salts"))
    left_salted = (
        left.withColumn("_h", key_hash)
        .join(hot, "_h", "left")
        .withColumn("_salt", F.coalesce(spread.cast("int"), F.lit(0)))
        .drop("_h", "_salts")
    )
    last_salt = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    right_salted = (
        right.withColumn("_h", key_hash)
        .join(hot, "_h", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last_salt)))
        .drop("_h", "_salts")
    )
    return left_salted.join(right_salted, [*on, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """Hashes of the keys that hold more rows than an average shuffle partition (or ``HOT_SHARE`` of them, if that is
    less), and over how many salts to spread each: at most a few rows per partition, and salts in the order of
    the shuffle partitions in all.

    A frequent-items sketch finds them in one pass without shuffling keys. It only steers where
    rows go; the join's result does not depend on it. Sketches are merged in groups before they meet
    in one task, so that task's input does not grow with the number of partitions.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = min(HOT_SHARE, 1 / partitions)
    tracked = min(MOST_TRACKED, max(LEAST_TRACKED, TRACKED_PER_PARTITION * partitions))
    names = ", ".join(f"`{c}`" for c in on)
    sketch = F.expr(f"approx_top_k_accumulate(xxhash64({names}), {tracked})")
    merged = F.expr(f"approx_top_k_combine(sketch, {tracked})")
    most = min(tracked, int(1 / least) + 1)
    return (
        df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("part"))
        .agg(sketch.alias("sketch"), F.count(F.lit(1)).alias("n"))
        .groupBy(F.lit(0).alias("all"))  # unlike a global merge, it stands empty partitions
        .agg(merged.alias("sketch"), F.sum("n").alias("n"))
        .select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("t"), "n")
        .withColumn("share", F.col("t.count") / F.col("n"))
        .where(F.col("share") > least)
        .select(
            F.col("t.item").alias("_h"),
            F.ceil(F.col("share") * partitions * SALTS_PER_PARTITION).cast("int").alias("_salts"),
        )
    )
