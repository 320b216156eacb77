"""Capture order, limits, progress and the walk along next-page links."""

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain import fixed_values as V
from shopgrain.functions.text import rate_line
from shopgrain.operators.lookup import salted_join, small
from shopgrain.operators.ordinal import with_running_totals
from shopgrain.sources.scratch import materialise, measured

MAX_HOPS = 1 << 60


def first_pages(pages: DataFrame, max_pages: int) -> DataFrame:
    """The pages within the page limit; 0 means no limit. The filter reaches the scan.

    The limit counts pages, whatever their numbers; rows of one number are one page. A page without a number takes no part in
    any run, with or without limits.
    """
    numbered = pages.where("page_no IS NOT NULL")
    if max_pages <= 0:
        return numbered
    numbers = numbered.select("page_no").distinct()
    last = numbers.orderBy("page_no").limit(max_pages).agg(F.max("page_no")).first()[0]
    return numbered.where(F.col("page_no") <= F.lit(last))


def capture_links(page_links: DataFrame, max_items: int = 0, max_pages: int = 0) -> DataFrame:
    """One row per link with its capture ordinal ``ord``, within both limits.

    ``page_links(page_no, page_url, links)`` holds each page's links in document order. A page that is there several times
    counts once, with the shortest of its link lists. Pages without a number take no part.
    """
    pages = first_pages(page_links, max_pages)
    if max_items > 0:
        pages = _pages_that_fill(pages, max_items)
    shortest = F.min(F.struct(F.size("links").alias("n_links"), "links")).alias("least")
    once = pages.groupBy("page_no", "page_url").agg(shortest)
    # Placing reads its input twice, so the pages are parsed into a table of their own first.
    counted = materialise(once.select("page_no", "page_url", "least.*"), "page-links")
    placed = with_running_totals(counted, ["page_no", "page_url"], {"before": "n_links"})
    if max_items > 0:
        placed = placed.where(F.col("before") < max_items)
    links = placed.select(
        "page_no", "page_url", "before", F.posexplode("links").alias("pos", "url")
    ).withColumn("ord", F.col("before") + F.col("pos") + 1)
    if max_items > 0:
        links = links.where(F.col("ord") <= max_items)
    return links.select("page_no", "page_url", "pos", "ord", "url")


def _pages_that_fill(pages: DataFrame, max_items: int) -> DataFrame:
    """The pages up to the one that fills the limit, told by a pass that only counts links."""
    sizes = pages.groupBy("page_no", "page_url").agg(F.min(F.size("links")).alias("n"))
    counts = materialise(sizes.groupBy("page_no").agg(F.sum("n").alias("n")), "link-counts")
    before = with_running_totals(counts, "page_no", {"before": "n"})
    last = before.where(F.col("before") < max_items).agg(F.max("page_no")).first()[0]
    return pages.where(F.col("page_no") <= F.lit(last))


def visited_pages(page_counts: DataFrame, max_items: int = 0, max_pages: int = 0) -> DataFrame:
    """Pages that a run visits: ``visit`` number and items captured before the page.

    ``page_counts(page_no, links)`` has one row per page; a page without a number is not visited.
    """
    totals = {"captured_before": "links", "visit": F.lit(1)}
    numbered = page_counts.where("page_no IS NOT NULL")
    placed = with_running_totals(numbered, "page_no", totals).withColumn(
        "visit", F.col("visit") + 1
    )
    if max_pages > 0:
        placed = placed.where(F.col("visit") <= max_pages)
    if max_items > 0:
        placed = placed.where(F.col("captured_before") < max_items)
    return placed


def stop_line(visited: DataFrame, max_items: int = 0, max_pages: int = 0) -> DataFrame:
    """Why a run ended, as one row (item limit, then page limit, then no next page)."""
    ended = visited.agg(
        F.coalesce(F.max("visit"), F.lit(0)).alias("visits"),
        F.coalesce(F.max(F.col("captured_before") + F.col("links")), F.lit(0)).alias("captured"),
    )
    reason = F.lit(V.NO_NEXT_PAGE_LINE)
    if max_pages > 0:
        hit = F.col("visits") >= max_pages
        reason = F.when(hit, F.lit(V.PAGE_LIMIT_LINE % max_pages)).otherwise(reason)
    if max_items > 0:
        hit = F.col("captured") >= max_items
        reason = F.when(hit, F.lit(V.ITEM_LIMIT_LINE % max_items)).otherwise(reason)
    return ended.select((F.col("visits") + 1).alias("seq"), reason.alias("line"))


def progress_report(
    page_counts: DataFrame, rate: Column, max_items: int = 0, max_pages: int = 0
) -> DataFrame:
    """Lines of a run in order ``seq``: the rate, each page visited, and why it ended."""
    spark = page_counts.sparkSession
    visited = visited_pages(page_counts, max_items, max_pages)
    head = spark.range(1).select(F.lit(0).cast("bigint").alias("seq"), rate.alias("rate"))
    lines = visited.select(
        F.col("visit").alias("seq"),
        F.format_string(V.PROGRESS_LINE, "visit", "links", "captured_before").alias("line"),
    )
    return (
        head.select("seq", rate_line("rate").alias("line"))
        .unionByName(lines)
        .unionByName(stop_line(visited, max_items, max_pages))
    )


def walk_chain(nodes: DataFrame, starts: DataFrame, max_pages: int = 0) -> DataFrame:
    """Follow next links from each start: rows ``(start, node, hop)``, hop 0 at the start itself.

    A node that comes several times in ``nodes(node, next)`` counts once, with its least next. The length of a jump grows by a factor each round,
    so a chain of n pages takes a number of joins that grows with log n. A page already reached from
    the same start is not entered again, so a cycle ends the walk. Rounds are written out, so a lost
    executor repeats one round at most.
    """
    once = nodes.groupBy("node").agg(F.min("next").alias("next"))
    pages, size = measured(once, "chain-nodes")
    known = pages.select("node")
    # Longer jumps have the same nodes or fewer, so what fits once always fits.
    fits = small(size)
    per_round = 4 if fits else 2

    def jump(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
        if fits:
            return left.join(F.broadcast(right), on, how)
        return salted_join(left, right, [on], how)

    linked = pages.where("next is not null")
    jumps = jump(linked, known.withColumnRenamed("node", "next"), "next", "left_semi")
    jumps = materialise(jumps.select("node", "next"), "chain-jumps")
    reached, size = measured(
        starts.select(F.col("node").alias("start"), "node").distinct()
        .join(known, "node", "left_semi")
        .select("start", "node", F.lit(0).cast("bigint").alias("hop")),
        "chain-reached",
    )
    n_reached = size.rows
    length = 1
    while (max_pages <= 0 or length < max_pages) and length <= MAX_HOPS:
        moved = everywhere = reached
        further = jumps
        for _ in range(per_round - 1):
            moved = jump(moved, jumps, "node").select(
                "start", F.col("next").alias("node"), (F.col("hop") + length).alias("hop")
            )
            everywhere = everywhere.unionByName(moved)
            onward = jumps.select(F.col("node").alias("next"), F.col("next").alias("far"))
            further = jump(further, onward, "next").select("node", F.col("far").alias("next"))
        reached, size = measured(
            everywhere.groupBy("start", "node").agg(F.min("hop").alias("hop")), "chain-reached"
        )
        if size.rows == n_reached:
            break
        n_reached = size.rows
        length *= per_round
        jumps = materialise(further, "chain-jumps")
    return reached.where(F.col("hop") < max_pages) if max_pages > 0 else reached
