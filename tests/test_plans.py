"""What the plans of the main queries must and must not hold."""

import re

import pytest

from pyspark.sql import functions as F
from shopgrain.operators import keyed, lookup
from shopgrain.sources.pages import product_records, product_texts
from shopgrain.sources.scratch import materialise
from tests.conftest import SF_DIR
from workload import tables as W
from workload.queries import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "dashboard_part", "dashboard_offers", "dashboard_offers_salted", "clean_items", "enriched_items",
    "label_lookup", "translate_titles", "convert_prices", "format_prices", "page_fields", "page_links",
    "json_path", "quote_keys", "table_names", "first_wins", "new_rows", "existing_rows",
    "upsert_dashboard", "evolve_union", "empty_run",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_of_all_rows_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("dashboard_offers", "lineitem", {"l_partkey", "l_quantity", "l_extendedprice"}),
        ("page_fields", "pages", {"page_id", "html"}),
        ("json_path", "events", {"event_id", "event_type", "props"}),
    ],
)
def test_scans_read_only_what_is_used(spark, name, table, columns):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    scan = next(line for line in plan.splitlines() if f"{table}.parquet" in line)
    schema = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_time_filters_reach_the_scan(spark):
    plan = plan_of(W.before_cut(W.table(spark, SF_DIR, "events")))
    assert "LessThan(ts," in plan


def test_hot_keys_shrink_before_the_shuffle(spark):
    events = W.table(spark, SF_DIR, "events")
    plan = plan_of(keyed.first_wins(events, ["user_id"], ["ts"]))
    before_shuffle = plan[plan.index("Exchange") :]
    assert "partial_min" in before_shuffle and plan.count("Exchange") == 1


def test_html_is_not_shuffled(spark):
    pages = W.table(spark, SF_DIR, "pages")
    records = keyed.first_wins(product_records(product_texts(pages)), ["url"], ["title_src"])
    plan = plan_of(records)
    shuffled = plan[: plan.index("Exchange")] + plan[plan.index("Exchange") :].splitlines()[1]
    assert "html" not in shuffled


def test_a_small_batch_does_not_shuffle_the_target(spark):
    events = W.table(spark, SF_DIR, "events")
    batch = materialise(events.where("event_id < 5").select("user_id").distinct(), "batch")
    held = keyed.held_keys(batch, events, ["user_id"])
    plan = plan_of(batch.join(held, "user_id", "left_anti"))
    assert "LeftSemi" in plan and "Exchange hashpartitioning" not in plan


def test_a_measured_lookup_does_not_shuffle_the_left(spark):
    lines = W.table(spark, SF_DIR, "lineitem").select("l_partkey", "l_quantity")
    parts = W.table(spark, SF_DIR, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    assert "Exchange hashpartitioning" not in plan_of(lookup.lookup(lines, parts, ["l_partkey"]))
