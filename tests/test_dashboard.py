from decimal import Decimal

from shopgrain.operators.dashboard import (
    dashboard,
    in_report_order,
    labelled_dashboard,
    named_categories,
)
from tests.helpers import sorted_rows

ROWS = [
    ("a", "1.00", True, "Travel"),
    ("b", "2.00", False, "Travel"),
    (None, "6.00", True, "Travel"),
    ("c", None, True, "viagem"),
    ("d", None, False, "Art"),
    ("e", "1.10", False, None),
    ("f", "1.20", False, None),
    ("g", "3.00", False, " "),
]


def items(spark):
    return spark.createDataFrame(
        [(t, p and Decimal(p), s, c) for t, p, s, c in ROWS],
        "title string, price decimal(18,2), low_stock boolean, category string",
    )


def test_counts_titles_and_skips_missing_prices(spark):
    assert sorted_rows(dashboard(items(spark), "category")) == sorted(
        [
            ("Travel", 2, 3.0, 2),
            ("viagem", 1, None, 1),
            ("Art", 1, None, 0),
            (None, 2, 1.15, 0),
            (" ", 1, 3.0, 0),
        ],
        key=repr,
    )


def test_a_label_and_a_text_equal_to_it_are_one_group(spark):
    rows = {r.category: tuple(r)[1:] for r in labelled_dashboard(items(spark)).collect()}
    assert rows["viagem"] == (3, 3.0, 3)
    assert rows["arte"] == (1, None, 0)
    assert rows[None] == (2, 1.15, 0)


def test_report_order_puts_the_null_category_last_among_equals(spark):
    ordered = in_report_order(dashboard(items(spark), "category"))
    assert [r.category for r in ordered.collect()] == ["Travel", None, " ", "Art", "viagem"]


def test_named_categories(spark):
    assert sorted_rows(named_categories(items(spark), "category")) == [
        ("Art",), ("Travel",), ("viagem",),
    ]


def test_empty_input(spark):
    assert dashboard(items(spark).where("false"), "category").count() == 0
