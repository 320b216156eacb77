"""The items table: from raw pages, or from offers that are already one row per product."""

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain import schema as S
from shopgrain.operators.capture import capture_links, walk_chain
from shopgrain.operators.enrich import run_rate, with_label, with_price, with_translation
from shopgrain.operators.keyed import conform, first_wins
from shopgrain.operators.lookup import fits_broadcast, lookup
from shopgrain.sources.pages import (
    SHOP,
    PagePatterns,
    clean_texts,
    next_pages,
    page_links,
    product_records,
    product_texts,
)
from shopgrain.sources.scratch import materialise


def enrich_records(
    records: DataFrame,
    rate: Column,
    translations: DataFrame | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Items in the working schema from product records."""
    translated = with_translation(records, translations)
    return conform(with_label(with_price(translated, rate), labels=labels), S.ITEM)


def items_from_offers(
    offers: DataFrame,
    rate: Column,
    translations: DataFrame | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Items from a table of raw offer texts that already has its order in ``ord``."""
    return enrich_records(product_records(clean_texts(offers), ("ord",)), rate, translations, labels)


def listing_in_order(
    pages: DataFrame, start_url: str, max_pages: int = 0, patterns: PagePatterns = SHOP
) -> DataFrame:
    """Links of the listing pages reached from a start page, numbered along the chain from 1.

    A page that is stored twice counts once. No html is shuffled: a short chain is broadcast to pick its pages, and for a long one the links
    are cut out before the join.
    """
    starts = pages.where(F.col("url") == start_url).select(F.col("url").alias("node"))
    chain = walk_chain(next_pages(pages, patterns), starts, max_pages)
    numbers = chain.select(F.col("node").alias("url"), (F.col("hop") + 1).alias("page_no"))
    texts = pages.select("url", "html")
    if fits_broadcast(numbers):
        return page_links(texts.join(F.broadcast(numbers), "url"), patterns)
    links = page_links(texts.withColumn("page_no", F.lit(0)), patterns).drop("page_no")
    once = links.groupBy("page_url").agg(F.min("links").alias("links"))
    placed = numbers.withColumnRenamed("url", "page_url")
    return once.join(placed, "page_url").select("page_no", "page_url", "links")


def items_from_pages(
    listing: DataFrame,
    details: DataFrame,
    rates: DataFrame | None = None,
    fixed_rate: float = 0,
    translations: DataFrame | None = None,
    labels: DataFrame | None = None,
    start_url: str | None = None,
    max_pages: int = 0,
    max_items: int = 0,
    patterns: PagePatterns = SHOP,
) -> DataFrame:
    """Items in capture order from listing pages and product pages.

    ``listing(page_no, url, html)`` is taken in ``page_no`` order, or, with a ``start_url``, along its
    next-page links. ``details(url, html)`` holds the product pages. Limits of 0 mean no limit.
    """
    if start_url is None:
        links = capture_links(page_links(listing, patterns), max_items, max_pages)
    else:
        chain = listing_in_order(listing, start_url, max_pages, patterns)
        links = capture_links(chain, max_items)
    wanted = links.select("url").distinct()
    if max_items > 0 and fits_broadcast(wanted):
        # Few links: other pages are skipped before they are parsed, without a shuffle of html.
        details = details.join(F.broadcast(wanted), "url", "left_semi")
    # Measured and then joined, so the pages are parsed once. Of copies, one with a title wins.
    parsed = product_records(product_texts(details, patterns)).withColumn(
        "untitled", F.col("title_src").isNull()
    )
    records = materialise(first_wins(parsed, ["url"], ["untitled"]).drop("untitled"), "records")
    # Enriched before they meet the links, so that no enrichment works out the join twice.
    enriched = enrich_records(records, run_rate(rates, fixed_rate), translations, labels)
    captured = lookup(links.select("ord", "url"), enriched.drop("ord"), ["url"])
    return conform(
        captured.withColumn("low_stock", F.coalesce("low_stock", F.lit(False))), S.ITEM
    )
