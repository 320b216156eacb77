from decimal import Decimal

import pytest

from shopgrain import schema as S
from shopgrain.plans import items as plan
from tests.samples import detail_page, listing_page

PAGES = [
    listing_page(1, ["a.html", "b.html", "a.html"], False),
    listing_page(2, [], False),
    listing_page(3, ["missing.html", "c.html"], True),
    (9, "http://s.example/c/page-9.html", listing_page(9, ["z.html"], True)[2]),
]
DETAILS = [
    detail_page("a", "Alpha", "£10.00", "Travel", "Two", 3),
    detail_page("b", "Beta", "n/a", "Odd", "Ten", 7),
    detail_page("c", "Gamma", "£1,5", "Art", "Five", 0),
    detail_page("z", "Never linked from the chain", "£1.00", "Art", "One", 1),
]
START = "http://s.example/c/page-1.html"


@pytest.fixture(scope="module")
def shop(spark):
    listing = spark.createDataFrame(PAGES, "page_no bigint, url string, html string")
    return listing, spark.createDataFrame(DETAILS, "url string, html string")


def titles(df):
    return [r.title_src for r in df.orderBy("ord").collect()]


def test_items_along_the_chain(spark, shop):
    listing, details = shop
    answers = spark.createDataFrame([("Alpha", "Alfa")], "key string, translated string")
    items = plan.items_from_pages(
        listing.drop("page_no"), details, fixed_rate=2, translations=answers, start_url=START
    )
    assert items.schema.simpleString() == S.ITEM.simpleString()
    rows = items.orderBy("ord").collect()
    assert [r.title for r in rows] == ["Alfa", "Beta", "Alfa", None, "Gamma"]
    assert [r.ord for r in rows] == [1, 2, 3, 4, 5]
    first = rows[0]
    assert (first.price, first.price_src) == (Decimal("20.00"), Decimal("10.0000"))
    assert (first.category, first.category_label) == ("Travel", "viagem")
    assert (first.rating, first.stock, first.low_stock) == (2, 3, True)
    assert (rows[1].price, rows[1].rating, rows[1].category_label) == (None, None, "Odd")
    assert (rows[4].price, rows[4].rating) == (Decimal("3.00"), 5)
    # A page that is not there leaves a row of nulls.
    assert (rows[3].url, rows[3].low_stock) == ("http://s.example/c/missing.html", False)


def test_items_in_page_order_and_limits(spark, shop):
    listing, details = shop
    assert titles(plan.items_from_pages(listing, details, max_items=0))[-1].startswith("Never")
    assert titles(plan.items_from_pages(listing, details, max_items=2)) == ["Alpha", "Beta"]
    assert titles(plan.items_from_pages(listing, details, max_pages=2)) == ["Alpha", "Beta", "Alpha"]
    limited = plan.items_from_pages(listing, details, max_pages=2, start_url=START, max_items=0)
    assert titles(limited) == ["Alpha", "Beta", "Alpha"]


def test_pages_stored_twice_change_nothing(spark, shop):
    listing, details = shop
    once = plan.items_from_pages(listing.drop("page_no"), details, start_url=START)
    twice = plan.items_from_pages(
        listing.drop("page_no").union(listing.drop("page_no")), details.union(details), start_url=START
    )
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_a_large_limit_parses_all_pages(spark, shop, monkeypatch):
    monkeypatch.setattr(plan, "fits_broadcast", lambda df: False)
    listing, details = shop
    assert titles(plan.items_from_pages(listing, details, max_items=3)) == ["Alpha", "Beta", "Alpha"]


def test_a_long_chain_is_joined_after_parsing(spark, shop, monkeypatch):
    listing, details = shop
    short = plan.listing_in_order(listing, START)
    monkeypatch.setattr(plan, "fits_broadcast", lambda df: False)
    long = plan.listing_in_order(listing, START)
    assert sorted(map(repr, short.collect())) == sorted(map(repr, long.collect()))
    assert short.columns == long.columns
