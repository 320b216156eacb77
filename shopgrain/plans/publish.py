"""Export of a run: the items, the dashboard and one sheet per category."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shopgrain import fixed_values as V
from shopgrain import schema as S
from shopgrain.operators.dashboard import dashboard, in_report_order
from shopgrain.operators.lookup import lookup
from shopgrain.operators.ordinal import with_place
from shopgrain.operators.sheets import placeholder_if_empty, sheet_names
from shopgrain.sources.scratch import materialise


@dataclass(frozen=True)
class Export:
    """Paths of one export. An empty run has only the message sheet."""

    root: str
    items: str | None = None
    dashboard: str | None = None
    sheets: str | None = None
    message: str | None = None


def export(
    items: DataFrame, out_dir: str, run_ts: datetime, name: str = "catalog", fmt: str = "parquet"
) -> Export:
    """Write a run below ``out_dir/<name>_<stamp>``.

    The items are computed once however costly they are; everything is made from that table. The sheet of all items and every
    category's sheet keep capture order: rows in a file are in order, and so are a sheet's files by their names. Repeating
    a run replaces it.
    """
    spark = items.sparkSession
    root = f"{out_dir.rstrip('/')}/{name}_{run_ts:%Y%m%d_%H%M%S}"
    items_path, dash_path = f"{root}/{V.ALL_SHEET}", f"{root}/{V.DASHBOARD_SHEET}"
    written = materialise(items, "items")
    _write(_in_files(written, "ord"), items_path, fmt)
    if written.isEmpty():
        path = f"{root}/{V.MESSAGE_SHEET}"
        _write(placeholder_if_empty(written).coalesce(1), path, fmt)
        return Export(root, message=path)

    dash = materialise(dashboard(written), "dashboard")
    _write(in_report_order(dash), dash_path, fmt)
    labels = dash.select(F.col("category").alias("category_label"))
    names = materialise(sheet_names(labels), "sheet-names")
    sheets_path = f"{root}/sheets"
    by_sheet = lookup(written, names, ["category_label"], "inner")
    _write(_in_files(by_sheet, "sheet", "ord"), sheets_path, fmt, "sheet")
    return Export(root, items_path, dash_path, sheets_path)


def _in_files(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in ranges of ``order``, one after the other in the numbers that files get.

    Ranges hold about as many rows each, so a hot sheet is written by many tasks; AQE merges small neighbours.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def rows_as_written(
    spark: SparkSession, exported: Export, items_schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """The rows of all category sheets with ``row``, their place in the sheet's files by name."""
    sheets = read_sheets(spark, exported, items_schema, fmt)
    at = sheets.select("*", "_metadata.file_name", F.col("_metadata.row_index").alias("file_row"))
    return with_place(at, "sheet", ["file_name", "file_row"], "row").drop("file_name", "file_row")


def read_sheets(
    spark: SparkSession, exported: Export, items_schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """All category sheets of an export as one table with its ``sheet`` column."""
    sheet = T.StructField("sheet", T.StringType())
    return _read(spark, exported.sheets, T.StructType([*items_schema.fields, sheet]), fmt)


def sheet_report(
    spark: SparkSession, exported: Export, items_schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Rows per sheet of an export, counted from what was written."""
    if exported.message:
        one = spark.range(1).select(F.lit(V.MESSAGE_SHEET).alias("sheet"))
        return one.withColumn("rows", F.lit(1).cast("bigint"))

    def size(df, name):
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("sheet"), "rows")

    sheets = read_sheets(spark, exported, items_schema, fmt)
    return (
        size(_read(spark, exported.items, items_schema, fmt), V.ALL_SHEET)
        .unionByName(size(_read(spark, exported.dashboard, S.DASHBOARD, fmt), V.DASHBOARD_SHEET))
        .unionByName(sheets.groupBy("sheet").agg(F.count(F.lit(1)).alias("rows")))
    )


# Text leaves and returns as it is, with its spaces and line breaks.
OPTIONS = {
    "csv": {
        "header": True,
        "multiLine": True,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
}


def _write(df: DataFrame, path: str, fmt: str, *partition_by: str) -> None:
    writer = df.write.mode("overwrite").format(fmt).options(**OPTIONS.get(fmt, {}))
    writer.partitionBy(*partition_by).save(path)


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    return spark.read.schema(schema).format(fmt).options(**OPTIONS.get(fmt, {})).load(path)
