"""Rate and translation tables from stored service answers."""

from pyspark.sql import DataFrame, functions as F

from shopgrain.functions.parse import rate_from_json, translation_from_json


def rates_from_payloads(payloads: DataFrame, currency: str = "BRL") -> DataFrame:
    """``rates(rate)`` from ``payloads(payload)``; unusable answers drop out."""
    return payloads.select(rate_from_json("payload", currency).alias("rate")).where(
        F.col("rate").isNotNull()
    )


def translations_from_payloads(payloads: DataFrame) -> DataFrame:
    """``translations(key, translated)`` from ``payloads(key, payload)``."""
    return payloads.select("key", translation_from_json("payload").alias("translated"))
