"""Sync of a run into stored tables: first-seen append per item table, upsert of the dashboard.

Every stored row has the version of its run. A run ends with a row in the table of runs, and readers see the versions up to the last
run that ended, of all tables alike. What a stopped run has appended is not seen until a later run ends, and is not
appended twice.
"""

from dataclasses import dataclass
from datetime import datetime
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shopgrain import fixed_values as V
from shopgrain import schema as S
from shopgrain.functions.text import qualified_table_name
from shopgrain.operators.dashboard import dashboard
from shopgrain.operators.keyed import conform, first_wins, held_keys, upsert, usable_key
from shopgrain.operators.lookup import lookup
from shopgrain.operators.ordinal import with_ordinal
from shopgrain.operators.sheets import sheet_names
from shopgrain.plans.tables import BUCKETS, PARTS, KeyedTable, PartedTable, StoredTable
from shopgrain.sources.scratch import materialise

REPORT = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("attempted", T.LongType()),
        T.StructField("inserted", T.LongType()),
    ]
)


VERSION = T.StructField("version", T.LongType())
RUN = T.StructType([VERSION, T.StructField("run_id", T.StringType())])


@dataclass(frozen=True)
class Catalog:
    """The stored tables below one path, and how their names are formed.

    ``buckets`` of the items and ``parts`` of the dashboard stay as they were when the tables were first written; choose them
    for the size that the tables will have.
    """

    spark: SparkSession
    path: str
    namespace: str = "catalog"
    table_prefix: str = "items_"
    buckets: int = BUCKETS
    parts: int = PARTS

    @cached_property
    def items(self) -> KeyedTable:
        """All item tables in one, told apart by ``table_name``."""
        schema = T.StructType([*S.STORED_ITEM.fields, VERSION])
        return KeyedTable(
            self.spark, f"{self.path}/items", schema, ("table_name", "url"), ("url",), self.buckets
        )

    @cached_property
    def dashboard(self) -> PartedTable:
        """Per category the row of the last run that had it, and the one before."""
        schema = T.StructType([*S.STORED_DASHBOARD.fields, VERSION])
        return PartedTable(self.spark, f"{self.path}/dashboard", schema, "category", self.parts)

    @cached_property
    def runs(self) -> StoredTable:
        """A row for each run that ended."""
        return StoredTable(self.spark, f"{self.path}/runs", RUN)

    def version(self) -> int:
        """The last run that ended; 0 before the first."""
        return self.runs.read().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def has_run(self, run_id: str) -> bool:
        return not self.runs.read().where(F.col("run_id") == run_id).isEmpty()

    def end_run(self, version: int, run_id: str) -> None:
        """Let readers see a version: one row, after all tables are written."""
        row = self.spark.range(1, numPartitions=1)
        self.runs.append(row.select(F.lit(version).alias("version"), F.lit(run_id).alias("run_id")))

    def stored_items(self) -> DataFrame:
        """What readers see of all item tables."""
        seen = self.items.read().where(F.col("version") <= self.version())
        return seen.select(*S.STORED_ITEM.fieldNames())

    def stored_dashboard(self) -> DataFrame:
        """What readers see of the dashboard."""
        return latest(self.dashboard.read(), self.version())

    def table(self, sheet):
        return qualified_table_name(sheet, self.namespace, self.table_prefix)

    def create_views(self) -> tuple[str, str]:
        """Views of the items and the dashboard as of one run, in the session's catalog; both are replaced together."""
        version = self.version()
        names = f"{self.namespace}_{self.table_prefix}all", f"{self.namespace}_dashboard"
        fields = ", ".join(S.STORED_DASHBOARD.fieldNames())
        self.spark.sql(
            f"CREATE OR REPLACE TEMPORARY VIEW {names[0]} AS"
            f" SELECT {', '.join(S.STORED_ITEM.fieldNames())} FROM {self.items.name} WHERE version <= {version}"
        )
        self.spark.sql(
            f"CREATE OR REPLACE TEMPORARY VIEW {names[1]} AS SELECT last.* FROM ("
            f"SELECT max_by(struct({fields}), version) AS last FROM {self.dashboard.name}"
            f" WHERE version <= {version} GROUP BY category)"
        )
        return names


def latest(rows: DataFrame, version: int) -> DataFrame:
    """Per category the row of the last version up to ``version``."""
    row = F.struct(*S.STORED_DASHBOARD.fieldNames())
    seen = rows.where(F.col("version") <= version).groupBy("category")
    return seen.agg(F.max_by(row, "version").alias("last")).select("last.*")


def instant(run_ts: datetime) -> Column:
    """A run's time as a literal; a time without a zone is in the session's zone."""
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp")


def routed(catalog: Catalog, items: DataFrame) -> DataFrame:
    """Every item once for the table of all items and once for its category's table.

    ``route`` is 0 for the table of all items. Items without a usable key go nowhere. Sheets whose
    names become the same table name share that table.
    """
    names = materialise(
        sheet_names(items).select("category_label", catalog.table("sheet").alias("own_table")),
        "tables",
    )
    with_tables = lookup(usable_key(items), names, ["category_label"])
    to_all = F.struct(
        F.lit(0).alias("route"), catalog.table(F.lit(V.ALL_SHEET)).alias("table_name")
    )
    to_own = F.struct(F.lit(1).alias("route"), F.col("own_table").alias("table_name"))
    routes = F.when(F.col("own_table").isNull(), F.array(to_all)).otherwise(F.array(to_all, to_own))
    return with_tables.select(*items.columns, F.explode(routes).alias("_to")).select(
        *items.columns, "_to.*"
    )


def append_items(catalog: Catalog, items: DataFrame, version: int, run_ts: datetime) -> DataFrame:
    """Append first-seen items to their tables; returns the report.

    Report: ``attempted`` counts the rows offered to a table (for the table of all items, those whose
    key it does not hold yet) and ``inserted`` those that were added.
    """
    table = catalog.items
    key = list(table.key)
    offered = materialise(
        first_wins(
            routed(catalog, items), key, ["route", "category_label", "ord"], copies="copies"
        ),
        "offered",
    )
    stored = table.read()
    # Both sides are unique on the key, so no key is hot. The result is read twice below.
    known = held_keys(offered, stored, key).withColumn("known", F.lit(True))
    marked = materialise(offered.join(known, key, "left"), "marked")
    fresh = marked.where("known IS NULL")
    last_ids = stored.groupBy("table_name").agg(F.max("id").alias("last_id"))
    rows = lookup(fresh, last_ids, ["table_name"]).withColumns(
        {
            "id": F.coalesce("last_id", F.lit(0)) + F.col("ord"),
            "collected_at": instant(run_ts),
            "version": F.lit(version),
        }
    )
    table.append(rows)
    fresh = F.col("known").isNull()
    return marked.groupBy("table_name").agg(
        F.sum(F.when((F.col("route") == 1) | fresh, F.col("copies")).otherwise(0)).alias(
            "attempted"
        ),
        F.sum(fresh.cast("bigint")).alias("inserted"),
    )


def refresh_dashboard(
    catalog: Catalog, items: DataFrame, version: int, run_ts: datetime
) -> DataFrame:
    """Upsert this run's dashboard; categories that the run lacks keep their last values.

    Only the partitions of the run's categories are read and written. They keep the rows that readers see until the run ends.
    """
    table = catalog.dashboard
    current = dashboard(items).where(F.col("category").isNotNull())
    numbered = materialise(
        with_ordinal(
            current.withColumn("_rank", -F.col("item_count")), ["_rank", "category"], "_ord"
        ),
        "dashboard",
    )
    last_id = table.read().agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).scalar()
    batch = numbered.select(
        (last_id + F.col("_ord")).alias("id"),
        *S.DASHBOARD.fieldNames(),
        instant(run_ts).alias("collected_at"),
    )
    near = table.near(numbered)
    seen = near.where(F.col("version") < version).groupBy("category")
    before = materialise(seen.agg(F.max_by(F.struct(*near.columns), "version").alias("last")), "seen")
    before = before.select("last.*")
    replaced = ["item_count", "avg_price", "low_stock_count", "collected_at"]
    after = upsert(conform(before, S.STORED_DASHBOARD), batch, "category", replaced)
    both = before.unionByName(after.withColumn("version", F.lit(version)))
    table.overwrite(materialise(conform(both, before.schema), "upserted"))
    inserted = numbered.join(before.select("category"), "category", "left_anti").agg(
        F.count(F.lit(1)).alias("inserted")
    )
    return numbered.agg(F.count(F.lit(1)).alias("attempted")).select(
        catalog.table(F.lit(V.DASHBOARD_SHEET)).alias("table_name"),
        "attempted",
        inserted.scalar().alias("inserted"),
    )


def sync(
    catalog: Catalog, items: DataFrame, run_id: str, run_ts: datetime, item_tables: bool = True
) -> DataFrame:
    """Bring all stored tables up to date with one run; returns the report per table.

    ``items`` is read several times: pass a written table. An empty run changes nothing, nor does a run that is in.
    Without ``item_tables`` only the dashboard is kept.
    """
    if items.isEmpty() or catalog.has_run(run_id):
        return conform(catalog.spark.range(0), REPORT)
    version = catalog.version() + 1
    tasks = [append_items] * item_tables + [refresh_dashboard]
    report = reduce(DataFrame.unionByName, [t(catalog, items, version, run_ts) for t in tasks])
    catalog.end_run(version, run_id)
    return report
