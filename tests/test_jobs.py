from datetime import datetime, timedelta

import pytest

from shopgrain import schema as S
from shopgrain.operators.keyed import conform
from shopgrain.plans.publish import export, read_sheets, rows_as_written, sheet_report
from shopgrain.plans.run import publish_run
from shopgrain.plans.sync import Catalog, sync
from tests.helpers import sorted_rows
from tests.samples import FIRST, SECOND, items

TS = datetime(2024, 2, 1, 12, 30, 45)


def report(df):
    return {r.table_name: (r.attempted, r.inserted) for r in df.collect()}


def test_sync_twice(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path), "ns", "p_")
    first = report(sync(catalog, items(spark, FIRST), "run-1", TS))
    assert first == {
        "ns.p_todos": (6, 5), "ns.p_arte": (3, 2), "ns.p_viagem": (1, 1), "ns.p_painel": (3, 3),
    }
    stored = catalog.stored_items()
    rows = {(r.table_name, r.url): (r.title, r.id, r.collected_at) for r in stored.collect()}
    assert rows["ns.p_todos", "u2"] == ("b", 2, TS)
    assert {u for t, u in rows if t == "ns.p_todos"} == {"u1", "u2", "u3", "u4", "u5"}
    assert {u for t, u in rows if t == "ns.p_arte"} == {"u1", "u2"}

    # The same run again changes nothing, and so do the same rows in a new run.
    assert report(sync(catalog, items(spark, FIRST), "run-1", TS)) == {}
    again = report(sync(catalog, items(spark, FIRST), "run-2", TS + timedelta(days=1)))
    assert again == {
        "ns.p_todos": (0, 0), "ns.p_arte": (3, 0), "ns.p_viagem": (1, 0), "ns.p_painel": (3, 0),
    }
    assert sorted_rows(catalog.stored_items()) == sorted_rows(stored)

    third = report(sync(catalog, items(spark, SECOND), "run-3", TS + timedelta(days=2)))
    assert third == {
        "ns.p_todos": (1, 1), "ns.p_arte": (2, 1), "ns.p_poesia": (1, 1), "ns.p_painel": (2, 1),
    }
    rows = {(r.table_name, r.url): (r.title, r.id) for r in catalog.stored_items().collect()}
    assert rows["ns.p_todos", "u1"] == ("a", 1)  # the first row stays
    assert rows["ns.p_todos", "u9"] == ("new", 5 + 2)
    assert rows["ns.p_poesia", "u3"] == ("moved", 3)

    dash = {r.category: r for r in catalog.stored_dashboard().collect()}
    assert set(dash) == {"arte", "viagem", " ", "poesia"}
    assert (dash["arte"].item_count, dash["arte"].avg_price) == (2, 53.5)  # this run only
    assert dash["arte"].collected_at == TS + timedelta(days=2)
    assert dash["viagem"].collected_at == TS + timedelta(days=1)  # a lost category stays
    ids = [r.id for r in dash.values()]
    assert len(set(ids)) == 4 and dash["poesia"].id == max(ids)


def test_sheets_of_one_table_name_share_the_table(spark, tmp_path):
    rows = [FIRST[0][:10] + ("A-B",) + FIRST[0][11:], FIRST[1][:10] + ("A B",) + FIRST[1][11:]]
    catalog = Catalog(spark, str(tmp_path))
    got = report(sync(catalog, items(spark, rows), "r", TS))
    assert got["catalog.items_a_b"] == (2, 2)


def test_a_category_named_like_the_message_sheet_is_synced(spark, tmp_path):
    rows = [FIRST[0][:10] + ("Informacoes",) + FIRST[0][11:]]
    got = report(sync(Catalog(spark, str(tmp_path)), items(spark, rows), "r", TS))
    assert got["catalog.items_informacoes"] == (1, 1)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_export(spark, tmp_path, fmt):
    exported = export(items(spark, FIRST), str(tmp_path), TS, "shop", fmt)
    assert exported.root == f"{tmp_path}/shop_20240201_123045"
    sizes = {r.sheet: r.rows for r in sheet_report(spark, exported, S.ITEM, fmt).collect()}
    assert sizes == {"Todos": 8, "Painel": 4, "arte": 5, "viagem": 1}
    sheets = read_sheets(spark, exported, S.ITEM, fmt)
    whole = spark.read.schema(S.ITEM).format(fmt).load(exported.items)
    if fmt == "parquet":
        assert sorted_rows(whole) == sorted_rows(items(spark, FIRST))
    assert {r.title for r in sheets.where("sheet = 'viagem'").collect()} == {"c"}
    assert (tmp_path / "shop_20240201_123045" / "sheets" / "sheet=arte").is_dir()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_sheets_keep_capture_order(spark, tmp_path, fmt):
    """Rows of every sheet, read file by file in the order of names, are in capture order; a hot sheet has several files."""
    rows = spark.range(5000).selectExpr(
        "concat('u', id) AS url", "(id * 7919) % 5000 + 1 AS ord", "'t' AS title",
        "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('c', id % 9) END AS category_label",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        exported = export(conform(rows, S.ITEM).repartition(7), str(tmp_path), TS, fmt=fmt)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    reader = spark.read.schema(S.ITEM).options(header=True)
    sheets = sorted((tmp_path / exported.sheets).glob("sheet=*")) + [tmp_path / exported.items]
    files = {}
    for sheet in sheets:
        files[sheet.name] = sorted(sheet.glob(f"*.{fmt}"))
        found = [r.ord for f in files[sheet.name] for r in reader.format(fmt).load(str(f)).coalesce(1).collect()]
        assert found == sorted(found) and len(found) == len(set(found)) > 0
    assert len(files["sheet=hot"]) > 3 and len(files) == 5
    if fmt == "parquet":
        placed = rows_as_written(spark, exported, S.ITEM).collect()
        for sheet in {r.sheet for r in placed}:
            mine = sorted((r.row, r.ord) for r in placed if r.sheet == sheet)
            assert [row for row, _ in mine] == list(range(1, len(mine) + 1))
            assert [o for _, o in mine] == sorted(o for _, o in mine)


def test_empty_run_exports_the_message_and_syncs_nothing(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "catalog"))
    exported, synced = publish_run(items(spark, []), str(tmp_path / "out"), TS, catalog)
    assert synced is None and exported.items is None
    message = spark.read.parquet(exported.message).collect()
    assert [r.message for r in message] == ["Nenhum dado extraído. Verifique seletores."]
    assert [tuple(r) for r in sheet_report(spark, exported, S.ITEM).collect()] == [("Informacoes", 1)]
    assert catalog.version() == 0


def test_nothing_to_sync(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    assert report(sync(catalog, items(spark, []), "r", TS)) == {}
    assert catalog.version() == 0 and catalog.items.read().isEmpty()


def test_whole_run(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "catalog"))
    export(items(spark, SECOND), str(tmp_path / "out"), TS, "x")  # left by a run that failed
    exported, synced = publish_run(items(spark, FIRST), str(tmp_path / "out"), TS, catalog, "x")
    assert spark.read.parquet(exported.items).count() == len(FIRST)
    assert {p.name for p in (tmp_path / "out" / exported.sheets).glob("sheet=*")} == {
        "sheet=arte", "sheet=viagem",
    }
    assert report(synced)["catalog.items_todos"] == (6, 5)
    assert [tuple(r) for r in catalog.runs.read().collect()] == [(1, "x_20240201_123045")]


def test_a_hot_sheet_is_written_by_many_tasks(spark, tmp_path):
    urls = spark.range(200_000).selectExpr(
        "concat('u', id) AS url", "id AS ord", "'t' AS title", "'arte' AS category_label"
    )
    hot = conform(urls, S.ITEM)
    for key, value in {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.files.maxPartitionBytes": "200k",
    }.items():
        spark.conf.set(key, value)
    try:
        exported = export(hot.repartition(16), str(tmp_path), TS)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    files = list((tmp_path / exported.root / "sheets" / "sheet=arte").glob("*.parquet"))
    assert len(files) > 1
