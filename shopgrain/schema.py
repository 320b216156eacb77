"""Schemas of the working table, the stored tables and the dashboard."""

from pyspark.sql import types as T

# The product of price and rate has 38 digits, so it is exact before it is rounded.
PRICE_SRC = T.DecimalType(19, 4)
RATE = T.DecimalType(18, 6)
PRICE = T.DecimalType(29, 2)

ITEM = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("title_src", T.StringType()),
        T.StructField("price", PRICE),
        T.StructField("price_src", PRICE_SRC),
        T.StructField("rating_word", T.StringType()),
        T.StructField("rating", T.IntegerType()),
        T.StructField("availability", T.StringType()),
        T.StructField("stock", T.LongType()),
        T.StructField("low_stock", T.BooleanType()),
        T.StructField("category", T.StringType()),
        T.StructField("category_label", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("ord", T.LongType()),
    ]
)

STORED_ITEM = T.StructType(
    [
        T.StructField("id", T.LongType()),
        *(f for f in ITEM.fields if f.name not in ("category_label", "ord")),
        T.StructField("collected_at", T.TimestampType()),
        T.StructField("table_name", T.StringType()),
    ]
)

DASHBOARD = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("item_count", T.LongType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("low_stock_count", T.LongType()),
    ]
)

STORED_DASHBOARD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        *DASHBOARD.fields,
        T.StructField("collected_at", T.TimestampType()),
    ]
)

MESSAGE = T.StructType([T.StructField("message", T.StringType())])
