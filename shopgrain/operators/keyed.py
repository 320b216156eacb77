"""First-seen append and keyed upsert, as DataFrame operators."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from shopgrain.operators.lookup import lookup, small
from shopgrain.sources.scratch import Size, size_columns

PROBED_ROWS = 200
SCAN_LIST = 10  # longer lists reach a Parquet scan as a range only


def usable_key(df: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key is neither null nor empty."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def first_wins(
    df: DataFrame, key: list[str], order_by: list[str], copies: str | None = None
) -> DataFrame:
    """The first row per key; ``copies`` names an optional column that counts the key's rows.

    The least row is an aggregate, so each map task sends one row per key: a hot key is reduced
    before the shuffle and never sorted in one task. Ties in ``order_by`` fall to the other columns,
    so the outcome is the same on every run.
    """
    rest = [*order_by, *(c for c in df.columns if c not in key and c not in order_by)]
    counts = [F.count(F.lit(1)).alias(copies)] if copies else []
    row = F.struct(*rest) if rest else F.lit(None)
    least = df.groupBy(*key).agg(F.min(row).alias("_least"), *counts)
    columns = [F.col(c) if c in key else F.col(f"_least.{c}") for c in df.columns]
    return least.select(*columns, *([copies] if copies else []))


def new_rows(batch: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Batch rows whose key is not in the target; a hot key of the batch is spread."""
    return lookup(batch, target.select(*key).distinct(), key, "left_anti")


def held_keys(batch: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Keys of the target that matter to a written batch that is unique on the key.

    For a batch measured to be small, the target is scanned past the broadcast batch keys instead of
    being shuffled, and what is left is no larger than the batch; for one of a few rows, their values go into the scan's
    filter, so that statistics and bloom filters skip what holds none of them. Otherwise all target keys.
    """
    keys = batch.select(*key)
    size = Size(*keys.agg(*size_columns(keys)).first())
    if not small(size):
        return target.select(*key)
    if size.rows <= PROBED_ROWS:
        target = target.where(_any_of(keys.collect(), key))
    return F.broadcast(target.select(*key).join(F.broadcast(keys), key, "left_semi"))


def _any_of(rows: list[Row], key: list[str]) -> Column:
    """Whether every key column has a value of these few rows; each list is short enough to reach the scan."""
    whole = F.lit(bool(rows))
    for k in key:
        values = sorted({r[k] for r in rows if r[k] is not None})
        parts = (values[i : i + SCAN_LIST] for i in range(0, len(values), SCAN_LIST))
        whole = whole & reduce(Column.__or__, (F.col(k).isin(part) for part in parts), F.lit(False))
    return whole


def existing_rows(batch: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Batch rows whose key is in the target; a hot key of the batch is spread."""
    return lookup(batch, target.select(*key).distinct(), key, "left_semi")


def append_if_absent(
    target: DataFrame, batch: DataFrame, key: list[str], order_by: list[str]
) -> DataFrame:
    """The rows to append: the first row of each key that the target does not hold yet."""
    return new_rows(first_wins(batch, key, order_by), target, key)


def upsert(target: DataFrame, batch: DataFrame, key: str, replace: list[str]) -> DataFrame:
    """The target after the batch: ``replace`` columns come from the batch where it has the key.

    Other columns hold on to the target's value when there is one. Keys only in the target stay;
    batch rows without a key are dropped. Both sides are unique on the key.
    """
    old = target.alias("old")
    new = batch.where(F.col(key).isNotNull()).alias("new")

    def merged(c: str) -> Column:
        old_value, new_value = F.col(f"old.{c}"), F.col(f"new.{c}")
        if c in replace:
            return F.when(F.col(f"new.{key}").isNotNull(), new_value).otherwise(old_value)
        return F.coalesce(old_value, new_value)

    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(*(merged(c).alias(c) for c in target.columns))


def conform(df: DataFrame, schema) -> DataFrame:
    """The schema's columns by name and in order; a missing column is null."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    full = df.withColumns(missing) if missing else df
    return full.select(*(F.col(f.name).cast(f.dataType) for f in schema))


def evolve_union(parts: list[DataFrame], schema) -> DataFrame:
    """Older and newer parts of a table as one, in the current schema."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return conform(whole, schema)
