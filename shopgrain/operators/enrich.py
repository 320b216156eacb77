"""Enrichment: category labels, title translations, exchange rate."""

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain import fixed_values as V
from shopgrain.functions.parse import converted_price
from shopgrain.functions.text import blank_to_null, slug, strip_ws
from shopgrain.functions.web import quote_key
from shopgrain.operators.lookup import lookup
from shopgrain.schema import RATE


def with_label(
    df: DataFrame, text: str = "category", out: str = "category_label", labels: DataFrame = None
) -> DataFrame:
    """Label of a text by its slug; a text that is not in the dictionary stays as it is.

    ``labels(key, label)`` is the dictionary, with unique keys; without it the built-in one is
    used, which is short enough to be a literal in the plan.
    """
    if labels is None:
        pairs = [F.lit(v) for kv in V.CATEGORY_LABELS.items() for v in kv]
        found = F.try_element_at(F.create_map(*pairs), slug(text))
        return df.withColumn(out, F.coalesce(found, F.col(text)))
    keyed = df.withColumn("_key", slug(text))
    known = labels.select(F.col("key").alias("_key"), F.col("label").alias("_label"))
    return (
        lookup(keyed, known, ["_key"])
        .withColumn(out, F.coalesce("_label", text))
        .drop("_key", "_label")
    )


def with_translation(
    df: DataFrame, translations: DataFrame | None, text: str = "title_src", out: str = "title"
) -> DataFrame:
    """Translated text by its stripped form.

    A blank text stays as it is; a text without a usable translation gives its stripped form.
    ``translations(key, translated)`` may hold failed and repeated answers; None turns
    translation off.
    """
    if translations is None:
        return df.withColumn(out, F.col(text))
    answers = (
        translations.select(
            blank_to_null("key").alias("_key"), blank_to_null("translated").alias("_answer")
        )
        .where(F.col("_key").isNotNull() & F.col("_answer").isNotNull())
        .groupBy("_key")
        .agg(F.min("_answer").alias("_answer"))
    )
    keyed = df.withColumn("_key", blank_to_null(text))
    return (
        lookup(keyed, answers, ["_key"], measure=translations.select("key", "translated"))
        .withColumn(out, F.coalesce("_answer", "_key", text))
        .drop("_key", "_answer")
    )


def translation_requests(
    df: DataFrame, translations: DataFrame | None = None, text: str = "title_src"
) -> DataFrame:
    """Distinct texts that have no answer yet, each with its encoded query form."""
    keys = df.select(blank_to_null(text).alias("key")).where("key is not null").distinct()
    if translations is not None:
        keys = keys.join(translations.select(strip_ws("key").alias("key")), "key", "left_anti")
    return keys.select("key", quote_key("key").alias("query"))


def run_rate(rates: DataFrame | None = None, fixed_rate: float = 0) -> Column:
    """The run's single rate: a positive fixed rate, else the last positive rate in ``rates(rate, as_of)``.

    Without a column ``as_of`` the table holds one run's rate; of several, as of several of one time, the largest
    counts. Null when there is none. It is a scalar subquery, so no join carries it to the rows.
    """
    if fixed_rate > 0:
        return F.lit(str(fixed_rate)).cast(RATE)
    if rates is None:
        return F.lit(None).cast(RATE)
    usable = F.col("rate").cast(RATE)
    order = [F.col("as_of")] if "as_of" in rates.columns else []
    last = F.max(F.struct(*order, usable.alias("rate")))["rate"]
    return rates.where(usable > 0).agg(last.alias("rate")).scalar()


def with_price(df: DataFrame, rate: Column) -> DataFrame:
    """Add ``price``: the source price at the run's rate, or rounded only when there is no rate."""
    return (
        df.withColumn("_rate", rate)
        .withColumn("price", converted_price("price_src", F.col("_rate")))
        .drop("_rate")
    )
