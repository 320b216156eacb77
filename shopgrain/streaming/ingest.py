"""Incremental runs over a file source."""

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shopgrain.operators.keyed import first_wins, held_keys
from shopgrain.plans.sync import Catalog, sync
from shopgrain.plans.tables import KeyedTable
from shopgrain.sources.scratch import materialise

STATE_STORE = "spark.sql.streaming.stateStore"
ROCKSDB_STATE = {
    f"{STATE_STORE}.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    f"{STATE_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream over the Parquet files at a path or glob."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def run_available(
    stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop."""
    return (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_id_of(batch: DataFrame, batch_id: int, name: str) -> str:
    """Names a batch of one checkpoint: a retry has the same name, a new checkpoint another one.

    The streaming query's own id is kept in its checkpoint.
    """
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{name}-{query_id}-{batch_id}"


def append_new_keys(
    stream: DataFrame, target: KeyedTable, order_by: list[str], checkpoint: str
) -> StreamingQuery:
    """Append each batch's first row per key that the target does not hold.

    First-seen state lives in the target. A retried batch finds its keys there and writes nothing twice, and a new
    checkpoint, which may see old and new files, adds what is new.
    """
    key = list(target.key)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        keyed = batch
        for k in key:
            keyed = keyed.where(F.col(k).isNotNull())
        first = materialise(first_wins(keyed, key, order_by), "stream-first")
        held = held_keys(first, target.read(), key)
        target.append(materialise(first.join(held, key, "left_anti"), "stream-new"))

    return run_available(stream, each_batch, checkpoint)


def first_seen_keys(stream: DataFrame, key: list[str]) -> DataFrame:
    """Each key once, when it first appears. State grows with the number of keys, see ``write_first_seen``."""
    return stream.select(*key).dropDuplicates(key)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    """The session's settings while a query starts; a query keeps those it started with."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_first_seen(
    stream: DataFrame, key: list[str], path: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Write each key once, when it first appears, whatever the number of keys.

    The keys seen are kept in RocksDB on the executors' disks, so memory does not grow with them, and a batch adds what it
    changes to the checkpoint, not the whole state.
    """
    with _settings(stream.sparkSession, ROCKSDB_STATE):
        writer = first_seen_keys(stream, key).writeStream.format(fmt)
        return (
            writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
        )


def keys_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys that a checkpoint of ``write_first_seen`` holds."""
    return spark.read.format("statestore").load(checkpoint).select("key.*")


def sync_batches(
    stream: DataFrame,
    to_items: Callable[[DataFrame], DataFrame],
    catalog: Catalog,
    checkpoint: str,
    name: str = "batch",
    run_ts: datetime | None = None,
    item_tables: bool = True,
) -> StreamingQuery:
    """Sync the catalog batch by batch; the dashboard covers the current batch only."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        items = materialise(to_items(batch), "stream-items")
        stamp = run_ts or datetime.now(timezone.utc)
        sync(catalog, items, run_id_of(batch, batch_id, name), stamp, item_tables)

    return run_available(stream, each_batch, checkpoint)
