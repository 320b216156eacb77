"""Sheet names and the empty-run placeholder."""

from pyspark.sql import DataFrame, functions as F

from shopgrain import fixed_values as V
from shopgrain.functions.text import sheet_base_name
from shopgrain.operators.dashboard import named_categories
from shopgrain.operators.lookup import lookup
from shopgrain.operators.ordinal import with_place
from shopgrain.sources.scratch import materialise


def sheet_names(labelled: DataFrame, label: str = "category_label") -> DataFrame:
    """One row ``(label, sheet)`` per named category, with unique sheet names.

    The first category with a name keeps it unless the name is reserved. Each later one gets the name's first
    characters and the next of ``_2``, ``_3``, ... in category order that no category has by nature; the stem gets
    shorter as the number gets longer, so names never exceed their length.
    """
    # Read several times below, so the categories are picked from the items once.
    named = materialise(
        named_categories(labelled, label).withColumn("_base", sheet_base_name(label)), "categories"
    )
    first = named.groupBy("_base").agg(F.min(label).alias("_first"))
    reserved = F.col("_base").isin(V.ALL_SHEET, V.DASHBOARD_SHEET)
    natural = materialise(
        lookup(named, first, ["_base"]).withColumn(
            "_clash", reserved | (F.col(label) != F.col("_first"))
        ),
        "natural-names",
    )
    kept = natural.where(~F.col("_clash")).select(label, F.col("_base").alias("sheet"))
    return _numbered(natural.where("_clash").select(label, "_base"), kept, label).unionByName(kept)


def _numbered(rest: DataFrame, kept: DataFrame, label: str) -> DataFrame:
    """Made names for the categories in ``rest``, none of them among ``kept``.

    Round by round of digits; what finds no number in one round goes to the next with a shorter stem. No task sees all
    categories of a stem.
    """
    numbered = r"^(.*)_([1-9][0-9]*)$"
    taken = kept.select(
        F.regexp_extract("sheet", numbered, 1).alias("_stem"),
        F.regexp_extract("sheet", numbered, 2).try_cast("bigint").alias("_number"),
    ).where("_number is not null")
    made, digits, low = rest.select(label, F.col("_base").alias("sheet")).where("false"), 2, 2
    while not rest.isEmpty():
        high = 10**digits - 1
        stem = F.substring("_base", 1, V.SHEET_NAME_CHARS - 1 - digits)
        wanted = rest.withColumn("_stem", stem)
        held = taken.where(F.col("_number").between(low, high)).distinct()
        placed = materialise(_free_numbers(wanted, held, label, low), "made-names")
        fits = placed.where(F.col("_number") <= high).select(
            label, F.concat_ws("_", "_stem", F.col("_number").cast("string")).alias("sheet")
        )
        made = made.unionByName(fits)
        rest = placed.where(F.col("_number") > high).select(label, "_base")
        digits, low = digits + 1, 10**digits
    return made


def _free_numbers(wanted: DataFrame, held: DataFrame, label: str, low: int) -> DataFrame:
    """``wanted`` with the k-th number from ``low`` on that is free in its stem, k by label.

    A held number comes before the k-th free one if fewer than k numbers below it are free. Sorted together that way, the
    numbers of a stem, held and wanted, follow each other without a gap, so a row's place among them gives its number.
    """
    ranked = with_place(wanted, "_stem", [label], "_at")
    if held.isEmpty():
        return ranked.withColumn("_number", F.col("_at") + (low - 1)).drop("_at")
    ranked_held = with_place(held, "_stem", ["_number"], "_nth")
    free_below = F.col("_number") - low - (F.col("_nth") - 1)
    both = ranked.withColumn("_is_wanted", F.lit(True)).unionByName(
        ranked_held.select("_stem", (free_below + 1).alias("_at"), F.lit(False).alias("_is_wanted")),
        allowMissingColumns=True,
    )
    merged = with_place(materialise(both, "numbers"), "_stem", ["_at", "_is_wanted"], "_place")
    return merged.where("_is_wanted").select(
        *wanted.columns, (F.col("_place") + (low - 1)).alias("_number")
    )


def placeholder_if_empty(df: DataFrame) -> DataFrame:
    """One message row when ``df`` has no rows, else nothing; decided when it runs."""
    message = df.sparkSession.range(1).select(F.lit(V.EMPTY_RUN_MESSAGE).alias("message"))
    return message.where(~df.select(F.lit(1)).exists())
