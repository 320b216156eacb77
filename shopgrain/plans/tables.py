"""Tables that are kept from run to run: Parquet tables of Spark's catalog, each at a path of its own.

They are plain Spark tables, so any reader of Parquet can use the files. A new session registers them again with
the layout they were written in. One writer at a time is assumed, as for any table without a transaction service.
"""

from hashlib import sha1

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shopgrain.operators.keyed import conform
from shopgrain.sources.scratch import path_exists

BUCKETS = 32
PARTS = 32
PART = "_part"


def _quoted(names) -> str:
    return ", ".join(f"`{n}`" for n in names)


class StoredTable:
    """A table that grows by appends. A column that older files lack reads as null."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        layout: str = "",
        options: dict[str, str] | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        described = f"{self.path} {schema.json()} {layout} {options}"
        self.name = f"stored_{sha1(described.encode()).hexdigest()[:20]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        written = "".join(f", '{k}' '{v}'" for k, v in (options or {}).items())
        place = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet"
            f" OPTIONS ('compression' 'snappy'{written}) {layout} LOCATION '{place}'"
        )

    def read(self) -> DataFrame:
        """All rows, as of now."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        conform(rows, self.schema).write.insertInto(self.name)


class KeyedTable(StoredTable):
    """Rows with a key, bucketed and sorted by it.

    Appended rows are shuffled to the buckets, a file for each. A join with the table on the whole key shuffles the other side
    only. ``probed`` names key columns that get a bloom filter, so that a search for a few values skips the row
    groups that lack them. Choose ``buckets`` for the size that the table will have.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: tuple[str, ...],
        probed: tuple[str, ...] = (),
        buckets: int = BUCKETS,
    ):
        self.key, self.buckets = tuple(key), buckets
        by = _quoted(key)
        layout = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
        bloom = {f"parquet.bloom.filter.enabled#{c}": "true" for c in probed}
        super().__init__(spark, path, schema, layout, bloom)

    def append(self, rows: DataFrame) -> None:
        super().append(conform(rows, self.schema).repartition(self.buckets, *self.key))


class PartedTable(StoredTable):
    """Rows with a key, partitioned by its hash: new contents of a few partitions leave the files of all others alone."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, parts: int = PARTS
    ):
        self.key, self.parts, self.columns = key, parts, schema.fieldNames()
        whole = T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])
        super().__init__(spark, path, whole, f"PARTITIONED BY ({PART})")

    def part(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def _find_parts(self) -> None:
        if path_exists(self.spark, self.path):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def _all(self) -> DataFrame:
        self._find_parts()  # that another session has added
        return super().read()

    def read(self) -> DataFrame:
        return self._all().select(*self.columns)

    def near(self, batch: DataFrame) -> DataFrame:
        """The rows of all partitions that the batch's keys fall into."""
        met = [r.p for r in batch.select(self.part().alias("p")).distinct().collect()]  # ``parts`` rows
        return self._all().where(F.col(PART).isin(met)).select(*self.columns)

    def overwrite(self, rows: DataFrame) -> None:
        """Replace the partitions that ``rows`` fall into by them; ``rows`` is not read from this table."""
        placed = conform(rows.withColumn(PART, self.part()), self.schema)
        writer = placed.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)
        self._find_parts()
