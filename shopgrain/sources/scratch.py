"""Scratch tables in the folder that all executors share.

A table that a job reads more than once is written here first: that cuts its lineage, keeps it when
executors are lost, and lets every later read prune columns.
"""

import tempfile
import uuid
from functools import cache, reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local run without one gets its own."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):  # local-cluster has executors
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shopgrain-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the scratch area."""
    application = spark.conf.get("spark.app.id", "session")
    return f"{scratch_root(spark)}/shopgrain-{application}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh scratch table and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path of any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class Size(NamedTuple):
    """Rows of a table and about as many bytes."""

    rows: int
    width: int


def _bytes(field: StructField) -> Column:
    kind = field.dataType
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, LongType):
        return F.array_size(field.name) * 8
    return F.octet_length(F.col(field.name).cast("string"))


def size_columns(df: DataFrame) -> tuple[Column, Column]:
    """Aggregates that give a table's ``Size``."""
    width = reduce(add, (F.coalesce(_bytes(f), F.lit(0)) + 16 for f in df.schema))
    total = F.coalesce(F.sum(width.cast("bigint")), F.lit(0))
    return F.count(F.lit(1)).alias("rows"), total.alias("width")


def measured(df: DataFrame, name: str) -> tuple[DataFrame, Size]:
    """``materialise`` and the table's size, counted by the job that writes it."""
    seen = Observation()
    table = materialise(df.observe(seen, *size_columns(df)), name)
    found = seen.get
    return table, Size(found["rows"], found["width"])
