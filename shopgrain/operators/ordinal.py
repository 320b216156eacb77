"""Ordinals and running totals over whole tables without a single-task sort.

Rows are range-partitioned in the wanted order and written out with their place in the partition. Per
partition one row meets in a single task to give each partition its start, and that small table, no
longer than the number of partitions, is broadcast back. The input is read twice, once for a sample that
sets the ranges: pass a written table where it is costly to compute.
"""

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from shopgrain.operators.lookup import lookup
from shopgrain.sources.scratch import materialise

INDEX_MASK = (1 << 33) - 1


def with_ordinal(
    df: DataFrame, order_by: list[str], out: str = "ord", partitions: int | None = None
) -> DataFrame:
    """Number all rows 1..n in the order of ``order_by``.

    The whole row takes part in the order, so neither a hot leading key nor copies of one row fill a
    task.
    """
    order = [*order_by, *(c for c in df.columns if c not in order_by)]
    placed = _placed(df, order, partitions)
    start = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", _before("_n", Window.orderBy("_part"), "_start"))
    )
    return placed.join(F.broadcast(start), "_part").select(
        *df.columns, (F.col("_start") + F.col("_index") + 1).alias(out)
    )


def with_place(
    df: DataFrame, group: str, order_by: list[str], out: str, partitions: int | None = None
) -> DataFrame:
    """Number the rows of each group 1..n in the order of ``order_by``; a large group is spread over tasks.

    Groups are numbered through with all others and each row then takes off its group's first number. ``group`` is not null.
    """
    numbered = materialise(with_ordinal(df, [group, *order_by], "_ord", partitions), "ordinals")
    first = numbered.groupBy(group).agg(F.min("_ord").alias("_first"))
    return lookup(numbered, first, [group]).select(
        *df.columns, (F.col("_ord") - F.col("_first") + 1).alias(out)
    )


def with_running_totals(
    pages: DataFrame, order_by: str | list[str], totals: dict[str, Column | str], partitions: int | None = None
) -> DataFrame:
    """Add, per page, the total of each measure over the pages before it; ``order_by`` is unique."""
    order = [order_by] if isinstance(order_by, str) else order_by
    measures = {k: F.col(v) if isinstance(v, str) else v for k, v in totals.items()}
    measured = pages.withColumns({f"_m_{k}": v.cast("bigint") for k, v in measures.items()})
    placed = _placed(measured, order, partitions)
    sums = placed.groupBy("_part").agg(*(F.sum(f"_m_{k}").alias(f"_s_{k}") for k in measures))
    parts, rows = Window.orderBy("_part"), Window.partitionBy("_part").orderBy("_index")
    start = sums.select("_part", *(_before(f"_s_{k}", parts, f"_b_{k}") for k in measures))
    within = placed.select("*", *(_before(f"_m_{k}", rows, f"_w_{k}") for k in measures))
    return within.join(F.broadcast(start), "_part").select(
        *pages.columns, *((F.col(f"_b_{k}") + F.col(f"_w_{k}")).alias(k) for k in measures)
    )


def _before(measure: str, window: WindowSpec, name: str) -> Column:
    """Total of a measure over the earlier rows of the window."""
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(measure).over(earlier), F.lit(0)).alias(name)


def _placed(df: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    """``df`` in ranges of ``order``: the range in ``_part``, the place in it in ``_index``.

    It is written out, because range bounds come from a sample and must not change between reads.
    Copies of one row are kept apart by the partition they come from.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(n, *order, "_from")
        .sortWithinPartitions(*order, "_from")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_index", F.monotonically_increasing_id().bitwiseAND(F.lit(INDEX_MASK)))
    )
    return materialise(placed.drop("_from"), "placed")
