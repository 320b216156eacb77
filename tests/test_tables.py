import pytest
from pyspark.sql import functions as F, types as T

from shopgrain.operators.keyed import held_keys
from shopgrain.plans import sync as sync_module
from shopgrain.plans.sync import Catalog, sync
from shopgrain.plans.tables import PART, KeyedTable, PartedTable, StoredTable
from tests.helpers import sorted_rows
from tests.samples import FIRST, SECOND, items
from tests.test_jobs import TS

SCHEMA = "k string, id bigint, v bigint"


def rows(spark, *ids):
    return spark.createDataFrame([(f"k{i % 3}", i, i * 10) for i in ids], SCHEMA)


def keyed(spark, path, key=("id",), **more):
    return KeyedTable(spark, str(path), rows(spark).schema, key, **more)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_appends_and_a_column_added_later(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), rows(spark).schema)
    assert table.read().collect() == [] and table.read().schema.names == ["k", "id", "v"]
    table.append(rows(spark, 1, 2))
    table.append(rows(spark, 3).select("v", "k", "id"))  # by name
    assert sorted_rows(table.read(), "id", "v") == [(1, 10), (2, 20), (3, 30)]
    wider = T.StructType([*table.schema.fields, T.StructField("b", T.StringType())])
    again = StoredTable(spark, table.path, wider)
    assert sorted_rows(again.read())[0] == ("k0", 3, 30, None)


def test_another_reader_needs_only_the_files(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    table.append(rows(spark, *range(50)))
    table.append(rows(spark, *range(50, 60)))
    assert spark.read.parquet(table.path).count() == 60


def test_a_new_session_finds_the_layout(spark, tmp_path):
    keyed(spark, tmp_path / "t").append(rows(spark, *range(50)))
    spark.sql(f"DROP TABLE {keyed(spark, tmp_path / 't').name}")  # as at the end of a session
    table = keyed(spark, tmp_path / "t")
    assert table.read().count() == 50 and len(files(tmp_path / "t")) <= table.buckets
    per_key = table.read().groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in per_key and "Exchange" not in per_key


def test_a_join_on_the_key_does_not_shuffle_the_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), rows(spark).schema, ("k", "id"))
    table.append(rows(spark, *range(1000)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        batch = rows(spark, *range(990, 1010))
        joined = batch.join(table.read().select("k", "id"), ["k", "id"], "left_anti")
        plan = joined._jdf.queryExecution().executedPlan()
        assert plan.toString().count("Exchange") == 1 and "SortMergeJoin" in plan.toString()
        assert "Bucketed: true" in plan.toString()
        assert sorted_rows(joined, "id") == [(i,) for i in range(1000, 1010)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def rows_scanned(df):
    """Rows that the plan's only scan gave out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_a_search_for_absent_keys_reads_no_rows(spark, tmp_path):
    """The values lie within the statistics of every file, so only the bloom filters can tell."""
    table = keyed(spark, tmp_path / "t", probed=("id",), buckets=4)
    table.append(rows(spark, *range(0, 20_000, 2)))
    found = table.read().where(F.col("id").isin([4001, 9999, 15_001]))
    assert rows_scanned(found) == 0
    assert rows_scanned(table.read().where(F.col("id").isin([4000]))) > 0
    plain = keyed(spark, tmp_path / "plain", buckets=4)
    plain.append(rows(spark, *range(0, 20_000, 2)))
    assert rows_scanned(plain.read().where(F.col("id").isin([4001, 9999, 15_001]))) > 0


@pytest.mark.parametrize("n", [0, 1, 25, 500])
def test_held_keys_of_batches_of_all_sizes(spark, tmp_path, n):
    table = keyed(spark, tmp_path / "t", ("k", "id"), probed=("id",))
    table.append(rows(spark, *range(0, 600, 2)))
    batch = rows(spark, *range(n))
    got = held_keys(batch, table.read(), ["k", "id"])
    assert sorted(r.id for r in got.collect()) == list(range(0, n, 2))


def test_a_batch_of_one_key_rewrites_one_partition(spark, tmp_path):
    table = PartedTable(spark, str(tmp_path / "t"), rows(spark).schema, "id", parts=8)
    assert table.read().collect() == [] and table.near(rows(spark, 5)).collect() == []
    table.overwrite(rows(spark, *range(100)))
    before = files(tmp_path / "t")
    near = table.near(rows(spark, 5))
    assert 0 < near.count() < 100
    kept = spark.createDataFrame([r for r in near.collect() if r.id != 5] + [("new", 5, -1)], table.read().schema)
    table.overwrite(kept)
    after = files(tmp_path / "t")
    gone = {f.split("/")[0] for f in before.keys() - after.keys()}
    assert len(gone) == 1 and gone == {f.split("/")[0] for f in after.keys() - before.keys()}
    assert table.read().count() == 100
    assert [tuple(r) for r in table.read().where("id = 5").collect()] == [("new", 5, -1)]
    assert PART not in table.read().columns


def seen(catalog):
    dash = {(r.category, r.item_count) for r in catalog.stored_dashboard().collect()}
    return sorted_rows(catalog.stored_items(), "table_name", "url"), dash


def test_readers_see_all_of_a_run_or_nothing(spark, tmp_path, monkeypatch):
    """A run that stops between its two tables leaves readers on the version before; a retry ends it."""
    catalog = Catalog(spark, str(tmp_path))
    sync(catalog, items(spark, FIRST), "run-1", TS)
    before = seen(catalog)

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(sync_module, "refresh_dashboard", stopped)
        with pytest.raises(RuntimeError):
            sync(catalog, items(spark, SECOND), "run-2", TS)
    assert catalog.items.read().count() > len(before[0])
    assert seen(catalog) == before
    with monkeypatch.context() as m:
        m.setattr(Catalog, "end_run", stopped)
        with pytest.raises(RuntimeError):
            sync(catalog, items(spark, SECOND), "run-2", TS)
    assert seen(catalog) == before  # also of the dashboard, whose partitions are written by now

    sync(catalog, items(spark, SECOND), "run-2", TS)
    other = Catalog(spark, str(tmp_path / "other"))
    sync(other, items(spark, FIRST), "run-1", TS)
    sync(other, items(spark, SECOND), "run-2", TS)
    assert seen(catalog) == seen(other) != before
    assert catalog.version() == 2


def test_views_show_one_run_of_all_tables(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path), "shop")
    sync(catalog, items(spark, FIRST), "run-1", TS)
    names = catalog.create_views()
    first = [sorted_rows(spark.table(n)) for n in names]
    assert first == [sorted_rows(catalog.stored_items()), sorted_rows(catalog.stored_dashboard())]
    sync(catalog, items(spark, SECOND), "run-2", TS)
    assert len(first[0]) == spark.table(names[0]).count()  # until the views are replaced
    catalog.create_views()
    assert sorted_rows(spark.table(names[0])) == sorted_rows(catalog.stored_items())
    assert sorted_rows(spark.table(names[1])) == sorted_rows(catalog.stored_dashboard())


def test_the_dashboard_keeps_two_rows_a_category(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    for i in range(4):
        sync(catalog, items(spark, FIRST if i % 2 else SECOND), f"run-{i}", TS)
    stored = catalog.dashboard.read().groupBy("category").count().collect()
    assert max(r["count"] for r in stored) <= 2
    assert catalog.stored_dashboard().count() == len(stored)
