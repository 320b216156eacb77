"""One whole run: pages to items, export, sync."""

from datetime import datetime

from pyspark.sql import DataFrame

from shopgrain.plans.publish import Export, export
from shopgrain.plans.sync import Catalog, sync


def publish_run(
    items: DataFrame,
    out_dir: str,
    run_ts: datetime,
    catalog: Catalog | None = None,
    name: str = "catalog",
) -> tuple[Export, DataFrame | None]:
    """Export the items and, with a catalog, sync it from the exported table.

    An empty run exports the message sheet and leaves the catalog as it is.
    """
    spark = items.sparkSession
    schema = items.schema
    exported = export(items, out_dir, run_ts, name)
    if catalog is None or exported.message:
        return exported, None
    written = spark.read.schema(schema).parquet(exported.items)
    return exported, sync(catalog, written, exported.root.rsplit("/", 1)[-1], run_ts)
