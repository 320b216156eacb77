"""One callable ``(spark, sf_dir) -> DataFrame`` per query. Money leaves as double."""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopgrain import schema as S
from shopgrain.functions import parse, text, web
from shopgrain.operators import capture, enrich, keyed
from shopgrain.operators.dashboard import dashboard, in_report_order, labelled_dashboard
from shopgrain.operators.lookup import lookup, salted_join
from shopgrain.operators.ordinal import with_ordinal
from shopgrain.operators.sheets import placeholder_if_empty, sheet_names as names_of_sheets
from shopgrain.plans.items import items_from_offers, items_from_pages
from shopgrain.plans.publish import export, rows_as_written, sheet_report
from shopgrain.plans.run import publish_run
from shopgrain.plans.sync import Catalog, instant, sync
from shopgrain.plans.tables import KeyedTable
from shopgrain.sources.pages import (
    clean_texts,
    page_fields as fields_of,
    pages_from_files,
    product_records,
)
from shopgrain.sources.payloads import rates_from_payloads, translations_from_payloads
from shopgrain.sources.scratch import materialise, scratch_path
from shopgrain.streaming.ingest import (
    append_new_keys,
    file_stream,
    keys_in_state,
    sync_batches,
    write_first_seen,
)
from workload import tables as W

PAGE_TEXTS = {
    "h1": r"(?s)<h1\b[^>]*>(.*?)</h1>",
    "page_title": r"(?s)<title\b[^>]*>(.*?)</title>",
    "ad": r'(?s)<div class="ad">(.*?)</div>',
    "no_such_text": r"(?s)<h6\b[^>]*>(.*?)</h6>",
}
PAGE_ATTRIBUTES = {"lang": r'<html lang="([^"]*)"', "charset": r'<meta charset="([^"]*)"'}
NAV_LINK = r'<li><a href="([^"]*)"'
ITEM_LIMIT, PAGE_LIMIT = 100, 12
PAGE_STEP = 10  # between page numbers, where they have gaps
UNNUMBERED = 7  # last digit of pages without a number


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _without_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("collected_at", F.col("collected_at").cast("timestamp_ntz"))


def _items(part: DataFrame, offers=W.offers_raw) -> DataFrame:
    spark = part.sparkSession
    rate = enrich.run_rate(W.rates(spark))
    return items_from_offers(offers(part), rate, W.translations(spark), W.labels(spark))


def _part_items(spark: SparkSession, sf_dir: str, offers=W.offers_raw) -> DataFrame:
    return _items(W.table(spark, sf_dir, "part"), offers)


# ---- extract, clean, summarise ----


def dashboard_part(spark, sf_dir):
    records = product_records(
        clean_texts(W.offers_raw(W.table(spark, sf_dir, "part"))).drop("ord"), ()
    )
    items = enrich.with_price(records, enrich.run_rate()).withColumnRenamed("title_src", "title")
    return in_report_order(dashboard(items, by="category"))


def dashboard_offers(spark, sf_dir):
    parts = W.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
    )
    offers = lookup(W.offers_large(W.table(spark, sf_dir, "lineitem")), parts, ["l_partkey"])
    priced = enrich.with_price(offers, enrich.run_rate(W.rates(spark)))
    flagged = priced.withColumn("low_stock", parse.low_stock("stock"))
    return in_report_order(labelled_dashboard(flagged, W.labels(spark)))


def dashboard_offers_salted(spark, sf_dir):
    """The same join with parts taken as too large to broadcast."""
    parts = W.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
    )
    offers = W.offers_large(W.table(spark, sf_dir, "lineitem"))
    joined = salted_join(offers, parts, ["l_partkey"])
    priced = enrich.with_price(joined, enrich.run_rate())
    return dashboard(priced.withColumn("low_stock", parse.low_stock("stock")), by="category")


def clean_items(spark, sf_dir):
    raw = W.offers_raw(W.table(spark, sf_dir, "part"))
    return _money(product_records(clean_texts(raw), ("ord",)), "price_src")


def enriched_items(spark, sf_dir):
    return _money(_part_items(spark, sf_dir), "price", "price_src")


def label_lookup(spark, sf_dir):
    part = W.table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    known = W.labels(spark)
    typed = enrich.with_label(part, "p_type", "type_label", known)
    return enrich.with_label(typed, "p_brand", "brand_label", known).withColumn(
        "brand_key", text.slug("p_brand")
    )


def label_lookup_builtin(spark, sf_dir):
    return enrich.with_label(W.shop_categories(W.table(spark, sf_dir, "part")))


def translate_titles(spark, sf_dir):
    raw = W.offers_raw(W.table(spark, sf_dir, "part")).select("ord", F.col("title").alias("src"))
    on = enrich.with_translation(raw, W.translations(spark), "src", "title")
    return enrich.with_translation(on, None, "src", "title_off")


def translation_requests(spark, sf_dir):
    raw = W.offers_raw(W.table(spark, sf_dir, "part"))
    return enrich.translation_requests(raw, W.translations(spark), "title")


def convert_prices(spark, sf_dir):
    records = product_records(clean_texts(W.offers_raw(W.table(spark, sf_dir, "part"))), ("ord",))
    rates = W.rates(spark)
    return records.select(
        "ord",
        F.col("price_src").cast("double").alias("price_src"),
        parse.converted_price("price_src", enrich.run_rate(rates)).cast("double").alias("online"),
        parse.converted_price("price_src", enrich.run_rate(rates, 7.25))
        .cast("double")
        .alias("fixed"),
        parse.converted_price("price_src", enrich.run_rate()).cast("double").alias("none"),
    )


def format_prices(spark, sf_dir):
    return _part_items(spark, sf_dir).select(
        "ord",
        text.price_label("price").alias("price_text"),
        text.price_label("price_src", "£").alias("source_text"),
        text.number_label("stock").alias("stock_text"),
        text.flag_label("low_stock").alias("low_text"),
        text.or_missing("title").alias("title_text"),
        text.one_line(text.or_missing("availability")).alias("availability_text"),
    )


def capture_report(spark, sf_dir):
    unnumbered = _part_items(spark, sf_dir).withColumnRenamed("ord", "key")
    items = with_ordinal(materialise(unnumbered, "items"), ["key"])
    return items.select(
        "ord",
        text.capture_line("ord").alias("line"),
        text.capture_line("ord", ITEM_LIMIT).alias("line_of_limit"),
    )


# ---- pages ----


def page_fields(spark, sf_dir):
    return fields_of(
        W.table(spark, sf_dir, "pages").drop("url"), PAGE_TEXTS, PAGE_ATTRIBUTES
    )


def stored_pages(spark, sf_dir):
    """The pages as files, some of them in a western character set, read back: the fields of ``page_fields``."""
    pages = W.table(spark, sf_dir, "pages")
    source = scratch_path(spark, "page-files")
    W.write_page_files(W.page_bytes(pages), source)
    read = pages_from_files(spark, source).drop("file")
    return fields_of(read, PAGE_TEXTS, PAGE_ATTRIBUTES)


def _nav_links(spark, sf_dir) -> DataFrame:
    hrefs = web.all_attributes("html", NAV_LINK)
    return W.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("page_no"),
        F.col("url").alias("page_url"),
        F.transform(hrefs, lambda h: web.resolve_link(F.col("url"), h)).alias("links"),
    )


def page_links(spark, sf_dir):
    return _nav_links(spark, sf_dir).select("page_no", F.posexplode("links").alias("pos", "url"))


def page_link_order(spark, sf_dir):
    return capture.capture_links(_nav_links(spark, sf_dir))


def page_link_limit(spark, sf_dir):
    """Two runs over page numbers with gaps, some missing: the page limit ends one, the item limit the other."""
    number = F.when(F.col("page_no") % 10 != UNNUMBERED, F.col("page_no") * PAGE_STEP)
    links = _nav_links(spark, sf_dir).withColumn("page_no", number)
    paged = capture.capture_links(links, 100 * ITEM_LIMIT, PAGE_LIMIT)
    counted = capture.capture_links(links, ITEM_LIMIT, 100 * PAGE_LIMIT)
    return paged.withColumn("run", F.lit("pages")).unionByName(
        counted.withColumn("run", F.lit("items"))
    )


def shop_items(spark, sf_dir):
    part = W.table(spark, sf_dir, "part")
    items = items_from_pages(
        W.shop_listing(part),
        W.shop_details(part),
        rates=W.rates(spark),
        translations=W.translations(spark),
        labels=W.labels(spark),
        start_url=f"{W.SHOP_ROOT}page-1.html",
        max_items=0,
    )
    return _money(items, "price", "price_src")


def chain_walk(spark, sf_dir):
    turns = W.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    nodes = turns.select(
        F.concat_ws(":", "conv_id", "turn").alias("node"),
        F.concat_ws(":", "conv_id", F.col("turn") + 1).alias("next"),
    )
    starts = turns.where("turn = 0").select(F.concat_ws(":", "conv_id", "turn").alias("node"))
    return capture.walk_chain(nodes, starts)


def capture_ordinal(spark, sf_dir):
    events = W.event_day(W.table(spark, sf_dir, "events")).select("page_no", "ts", "event_id")
    return with_ordinal(events, ["page_no", "ts", "event_id"]).drop("ts")


def progress_report(spark, sf_dir):
    counts = (
        W.event_day(W.table(spark, sf_dir, "events"))
        .groupBy("page_no")
        .agg(F.count(F.lit(1)).alias("links"))
    )
    rate = enrich.run_rate(W.rates(spark))
    whole = capture.progress_report(counts, rate).withColumn("run", F.lit("whole"))
    paged = capture.progress_report(counts, F.lit(None).cast(S.RATE), max_pages=7)
    limited = capture.progress_report(counts, rate, max_items=500, max_pages=25)
    return whole.unionByName(paged.withColumn("run", F.lit("pages"))).unionByName(
        limited.withColumn("run", F.lit("items"))
    )


# ---- text and payload functions ----


def json_path(spark, sf_dir):
    events = W.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    payload = F.when(k % 3 == 0, F.concat(F.lit('{"rates": {"BRL": '), k, F.lit("}}"))).otherwise(
        F.concat(F.lit('{"rates": {"USD": '), k, F.lit("}}"))
    )
    answer = (
        F.when(k % 4 == 0, F.lit('{"responseData": null}'))
        .when(k % 4 == 1, F.lit("not json"))
        .otherwise(
            F.concat(
                F.lit('{"responseData": {"translatedText": " '), "event_type", F.lit(' "}}')
            )
        )
    )
    read = events.select("event_id", payload.alias("payload"), answer.alias("answer"), k.alias("k"))
    return read.select(
        "event_id",
        "k",
        parse.rate_from_json("payload").cast("double").alias("rate"),
        parse.translation_from_json("answer").alias("answer"),
    )


def payload_tables(spark, sf_dir):
    """Rates and translations as run inputs, from stored answers."""
    events = W.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    rates = rates_from_payloads(
        events.select(F.concat(F.lit('{"rates": {"BRL": '), k, F.lit("}}")).alias("payload"))
    )
    answer = F.concat(
        F.lit('{"responseData": {"translatedText": "'), "event_type", F.lit('-"}}')
    )
    answers = translations_from_payloads(
        events.select(F.col("event_type").alias("key"), answer.alias("payload"))
    )
    named = enrich.with_translation(events, answers, "event_type", "translated")
    return named.groupBy("event_type", "translated").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "rate", enrich.run_rate(rates).cast("double")
    )


def quote_keys(spark, sf_dir):
    names = W.table(spark, sf_dir, "part").select(F.col("p_name").alias("key")).distinct()
    urls = W.table(spark, sf_dir, "pages").select(F.col("url").alias("key"))
    return names.union(urls).select("key", web.quote_key("key").alias("quoted"))


def table_names(spark, sf_dir):
    urls = W.table(spark, sf_dir, "pages").select(F.col("url").alias("name"))
    labels = W.sheet_categories(W.table(spark, sf_dir, "part")).select(
        F.col("category_label").alias("name")
    )
    whole = urls.union(labels.distinct())
    return whole.select(
        "name",
        text.table_name("name").alias("table_name"),
        text.qualified_table_name("name", "catalog", "items_").alias("qualified"),
        text.sheet_base_name("name").alias("sheet_base"),
    )


def sheet_names(spark, sf_dir):
    return names_of_sheets(W.sheet_categories(W.table(spark, sf_dir, "part"))).orderBy(
        "category_label"
    )


# ---- keyed tables ----

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


def first_wins(spark, sf_dir):
    lines = W.table(spark, sf_dir, "lineitem")
    return keyed.first_wins(lines, LINE_KEY, LINE_ORDER, copies="copies")


EVENT_KEY = ["user_id", "event_type"]


def _event_sides(spark, sf_dir):
    events = W.table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )
    return W.before_cut(events), W.after_cut(events)


def new_rows(spark, sf_dir):
    before, after = _event_sides(spark, sf_dir)
    return keyed.new_rows(after, before, ["user_id", "k"])


def existing_rows(spark, sf_dir):
    before, after = _event_sides(spark, sf_dir)
    return keyed.existing_rows(after, before, ["user_id", "k"])


def append_if_absent(spark, sf_dir):
    before, after = _event_sides(spark, sf_dir)
    key, order = ["user_id", "k"], ["ts", "event_id"]
    target = materialise(keyed.first_wins(before, key, order), "target")
    added = keyed.append_if_absent(target, after, key, order)
    last_id = target.agg(F.max("event_id")).scalar()
    stamped = added.select(
        (last_id + F.col("event_id")).alias("id"),
        *added.columns,
        instant(W.RUN_TS).alias("collected_at"),
    )
    return _without_zone(stamped.withColumn("stamp", text.run_stamp("collected_at")))


def upsert_dashboard(spark, sf_dir):
    before, after = W.before_cut, W.after_cut
    events = W.table(spark, sf_dir, "events")

    def side(cut, ts):
        return dashboard(W.event_items(cut(events))).withColumn("collected_at", instant(ts))

    target, batch = side(before, W.RUN_TS), side(after, W.RUN_TS + timedelta(days=1))
    replaced = [c for c in batch.columns if c != "category"]
    return _without_zone(keyed.upsert(target, batch, "category", replaced))


def evolve_union(spark, sf_dir):
    items = _part_items(spark, sf_dir)
    old = items.where("low_stock").drop("title_src", "price_src")
    whole = keyed.evolve_union([old, items.where("NOT low_stock")], S.ITEM)
    return _money(whole, "price", "price_src")


# ---- publish and sync ----


def category_fanout(spark, sf_dir):
    items = _part_items(spark, sf_dir)
    exported = export(items, scratch_path(spark, "export"), W.RUN_TS)
    stamp = exported.root.rsplit("/", 1)[-1]
    return sheet_report(spark, exported, items.schema).withColumn("run", F.lit(stamp))


def sheet_rows(spark, sf_dir):
    """The rows of each category's sheet in the order of its files."""
    items = _part_items(spark, sf_dir)
    exported = export(items, scratch_path(spark, "export"), W.RUN_TS)
    return rows_as_written(spark, exported, items.schema).select("sheet", "row", "ord", "url")


def sync_router(spark, sf_dir):
    """Two runs over the same offers: the second adds nothing."""
    items = materialise(_part_items(spark, sf_dir, W.offers_with_copies), "items")
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    first = sync(catalog, items, "run-1", W.RUN_TS).withColumn("run", F.lit(1))
    second = sync(catalog, items, "run-2", W.RUN_TS + timedelta(days=1))
    return first.unionByName(second.withColumn("run", F.lit(2)))


def stored_items(spark, sf_dir):
    """What the stored item tables hold after the two runs."""
    items = materialise(_part_items(spark, sf_dir, W.offers_with_copies), "items")
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    sync(catalog, items, "run-1", W.RUN_TS)
    sync(catalog, items, "run-2", W.RUN_TS + timedelta(days=1))
    return _without_zone(_money(catalog.stored_items(), "price", "price_src"))


def whole_run(spark, sf_dir):
    """From shop pages to items, export and stored tables: what was written, by sheet and by table."""
    part = W.table(spark, sf_dir, "part")
    items = items_from_pages(
        W.shop_listing(part),
        W.shop_details(part),
        rates=W.rates(spark),
        translations=W.translations(spark),
        labels=W.labels(spark),
        start_url=f"{W.SHOP_ROOT}page-1.html",
    )
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    exported, report = publish_run(items, scratch_path(spark, "export"), W.RUN_TS, catalog)
    sheets = sheet_report(spark, exported, items.schema).select(
        F.lit("sheet").alias("kind"), F.col("sheet").alias("name"), "rows", F.col("rows").alias("added")
    )
    tables = report.select(
        F.lit("table").alias("kind"),
        F.col("table_name").alias("name"),
        F.col("attempted").alias("rows"),
        F.col("inserted").alias("added"),
    )
    return sheets.unionByName(tables)


def empty_run(spark, sf_dir):
    part = W.table(spark, sf_dir, "part")
    none = placeholder_if_empty(part.where("p_size < 0")).withColumn("run", F.lit("empty"))
    return none.unionByName(placeholder_if_empty(part).withColumn("run", F.lit("full")))


# ---- streams ----


def _stream(spark, sf_dir, name) -> DataFrame:
    # A glob, because a single file is not a stream path.
    schema = W.table(spark, sf_dir, name).schema
    return file_stream(spark, f"{sf_dir}/{name}.parque[t]", schema)


def _event_stream(spark, sf_dir) -> DataFrame:
    return _stream(spark, sf_dir, "events")


def stream_offers(spark, sf_dir):
    """Raw offers as they arrive: cleaned, enriched and appended to their tables."""
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        sync_batches(
            _stream(spark, sf_dir, "part"), lambda part: _items(part, W.offers_with_copies),
            catalog, checkpoint, "offers", W.RUN_TS,
        ).awaitTermination()
    return _without_zone(_money(catalog.stored_items(), "price", "price_src"))


def stream_ingest(spark, sf_dir):
    """Two incremental runs, before and after the cut, append to one table."""
    schema = W.table(spark, sf_dir, "events").schema
    target = KeyedTable(spark, scratch_path(spark, "first-events"), schema, tuple(EVENT_KEY))
    for cut in (W.before_cut, W.after_cut):
        append_new_keys(
            cut(_event_stream(spark, sf_dir)), target, ["ts", "event_id"], scratch_path(spark, "stream")
        ).awaitTermination()
    return target.read()


def stream_new_checkpoint(spark, sf_dir):
    """Files arrive in two parts; the second run has lost its checkpoint and sees both."""
    events = W.table(spark, sf_dir, "events")
    source = scratch_path(spark, "arrived")
    target = KeyedTable(spark, scratch_path(spark, "first-events"), events.schema, tuple(EVENT_KEY))
    for cut in (W.before_cut, W.after_cut):
        cut(events).write.mode("append").parquet(source)
        append_new_keys(
            file_stream(spark, source, events.schema), target, ["ts", "event_id"],
            scratch_path(spark, "stream"),
        ).awaitTermination()
    return target.read()


def stream_first_seen(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "seen"), scratch_path(spark, "stream")
    events = _event_stream(spark, sf_dir)
    write_first_seen(events, EVENT_KEY, out, checkpoint).awaitTermination()
    return spark.read.schema(events.select(*EVENT_KEY).schema).parquet(out)


def stream_state(spark, sf_dir):
    """The keys that the state of two incremental runs holds."""
    events = W.table(spark, sf_dir, "events")
    source, out, checkpoint = (scratch_path(spark, n) for n in ("arrived", "seen", "stream"))
    for cut in (W.before_cut, W.after_cut):
        cut(events).write.mode("append").parquet(source)
        stream = file_stream(spark, source, events.schema)
        write_first_seen(stream, EVENT_KEY, out, checkpoint).awaitTermination()
    return keys_in_state(spark, checkpoint)


def stream_dashboard(spark, sf_dir):
    """Two incremental runs; the second replaces the categories it has."""
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    runs = ((W.before_cut, W.RUN_TS), (W.after_cut, W.RUN_TS + timedelta(days=1)))
    for cut, ts in runs:
        sync_batches(
            cut(_event_stream(spark, sf_dir)), W.event_items, catalog,
            scratch_path(spark, "stream"), run_ts=ts, item_tables=False,
        ).awaitTermination()
    return _without_zone(catalog.stored_dashboard().drop("id"))


QUERIES = {
    f.__name__: f
    for f in (
        dashboard_part,
        dashboard_offers,
        dashboard_offers_salted,
        clean_items,
        enriched_items,
        label_lookup,
        label_lookup_builtin,
        translate_titles,
        translation_requests,
        convert_prices,
        format_prices,
        capture_report,
        page_fields,
        stored_pages,
        page_links,
        page_link_order,
        page_link_limit,
        shop_items,
        chain_walk,
        capture_ordinal,
        progress_report,
        json_path,
        payload_tables,
        quote_keys,
        table_names,
        sheet_names,
        first_wins,
        new_rows,
        existing_rows,
        append_if_absent,
        upsert_dashboard,
        evolve_union,
        category_fanout,
        sheet_rows,
        sync_router,
        stored_items,
        whole_run,
        empty_run,
        stream_offers,
        stream_ingest,
        stream_new_checkpoint,
        stream_first_seen,
        stream_state,
        stream_dashboard,
    )
}
