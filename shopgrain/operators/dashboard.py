"""Per-category summary."""

from pyspark.sql import DataFrame, functions as F

from shopgrain.functions.text import strip_ws
from shopgrain.operators.enrich import with_label


MEASURES = ("item_count", "_sum", "_priced", "low_stock_count")


def dashboard(items: DataFrame, by: str = "category_label") -> DataFrame:
    """Titles, mean price and low-stock items per label; a null label is a group of its own.

    Sums are decimal, so the mean does not depend on the order of rows. Partial aggregation runs
    before the shuffle, so a hot label costs one row per map task.
    """
    return _with_mean(_sums(items, by))


def labelled_dashboard(items: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The dashboard by label of items that only have their ``category``.

    Items are summed by category first, so the label of a category is looked up once and not per
    item; categories with one label are then added up.
    """
    labelled = with_label(_sums(items, "category"), labels=labels)
    whole = labelled.groupBy(F.col("category_label").alias("category")).agg(
        *(F.sum(m).alias(m) for m in MEASURES)
    )
    return _with_mean(whole)


def _sums(items: DataFrame, by: str) -> DataFrame:
    return items.groupBy(F.col(by).alias("category")).agg(
        F.count("title").alias("item_count"),
        F.sum("price").alias("_sum"),
        F.count("price").alias("_priced"),
        F.sum(F.col("low_stock").cast("int")).alias("low_stock_count"),
    )


def _with_mean(sums: DataFrame) -> DataFrame:
    mean = F.when(F.col("_priced") > 0, F.col("_sum").cast("double") / F.col("_priced"))
    return sums.select("category", "item_count", mean.alias("avg_price"), "low_stock_count")


def in_report_order(dash: DataFrame) -> DataFrame:
    """Largest categories first, then by name; the null category last among equals."""
    return dash.orderBy(F.desc("item_count"), F.asc_nulls_last("category"))


def named_categories(df: DataFrame, label: str = "category_label") -> DataFrame:
    """Distinct labels that are neither null nor blank."""
    usable = F.col(label).isNotNull() & (strip_ws(label) != "")
    return df.where(usable).select(label).distinct()
