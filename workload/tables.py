"""The given tables in the shapes the library reads, and the inline tables beside them."""

import os
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopgrain import schema as S

RATE = 6.5355
RUN_TS = datetime(2024, 2, 1, 12, 30, 45)
CUT = "2024-01-15 00:00:00"

LABELS = [
    ("economy", "economico"),
    ("small", "pequeno"),
    ("standard", "padrao"),
    ("medium", "LARGE"),
    ("brand2", "marca_2"),
    ("brand17", "marca_17"),
]
TRANSLATIONS = [
    ("small ring", "anel pequeno"),
    ("red widget", "  componente vermelho "),
    ("hot gear", ""),
    ("blue bolt", None),
    ("old anvil", "bigorna velha"),
    (" cold plate\t", "prato frio"),
    ("new gizmo", "   "),
]
RATES = [0.0, -1.0, None, RATE]
SHOP_CATEGORIES = [
    "Travel",
    "  Science Fiction ",
    "Childrens",
    "Add a comment",
    "Womens Fiction",
    "Food and Drink",
    "Self\tHelp",
    "Art & Craft",
    "",
    "POETRY",
]
SHOP_ROOT = "http://shop.example/catalogue/"
PAGE_SIZE = 20
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's name for a null in a partition folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    def sql(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"{v}D"

    values = ", ".join(f"({', '.join(sql(v) for v in row)})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({schema})")


def labels(spark: SparkSession) -> DataFrame:
    return _inline(spark, LABELS, "key, label")


def translations(spark: SparkSession) -> DataFrame:
    return _inline(spark, TRANSLATIONS, "key, translated")


def rates(spark: SparkSession) -> DataFrame:
    return _inline(spark, [(r,) for r in RATES], "rate")


def offers_raw(part: DataFrame) -> DataFrame:
    """Offers with raw texts and faults of every kind that parsing must stand."""
    return part.selectExpr(
        "p_partkey AS ord",
        "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE '\\u00a0 ' || p_name || '\\t' END AS title",
        """CASE WHEN p_partkey % 29 = 0 THEN 'n/a'
                WHEN p_partkey % 7 = 0
                THEN '£' || replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING), '.', ',')
                ELSE '£' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)
           END AS price_text""",
        """'star-rating ' || element_at(
               array('Zero', 'One', 'Two', 'Three', 'Four', 'Five'), p_size % 6 + 1
           ) AS rating_class""",
        """CASE WHEN p_partkey % 31 = 0 THEN 'Out of stock'
                ELSE 'In stock\\n(' || p_size % 20 || ' available)' END AS availability""",
        "CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_type END AS category",
        """CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN ''
                ELSE 'catalogue/part-' || p_partkey END AS url""",
    )


def offers_with_copies(part: DataFrame) -> DataFrame:
    """The same offers, several of them under one url."""
    shared = F.concat(F.lit("catalogue/"), F.translate("p_name", " ", "-"), F.lit("/"), "p_brand")
    urls = part.select(F.col("p_partkey").alias("ord"), shared.alias("shared"))
    keyless = F.col("url").isNull() | (F.col("url") == "")
    return (
        offers_raw(part)
        .join(urls, "ord")
        .withColumn("url", F.when(keyless, F.col("url")).otherwise(F.col("shared")))
        .drop("shared")
    )


def offers_large(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        "l_partkey",
        F.col("l_extendedprice").cast(S.PRICE_SRC).alias("price_src"),
        F.col("l_quantity").cast("bigint").alias("stock"),
    )


def shop_categories(part: DataFrame) -> DataFrame:
    names = F.array(*(F.lit(c) for c in SHOP_CATEGORIES))
    return part.select(
        "p_partkey", F.get(names, F.col("p_size") % len(SHOP_CATEGORIES)).alias("category")
    )


def sheet_categories(part: DataFrame) -> DataFrame:
    """Category names with reserved, blank, illegal and over-long cases, hundreds of one stem, and some that equal
    made names."""
    return part.selectExpr(
        "p_partkey",
        """CASE p_size WHEN 1 THEN 'Todos' WHEN 2 THEN 'Painel' WHEN 3 THEN '   '
                WHEN 4 THEN 'a:b/[c]*d?e' WHEN 5 THEN NULL
                WHEN 6 THEN 'Todos_2' WHEN 7 THEN 'Everything for every househo_2'
                WHEN 8 THEN 'Everything for every househ_105'
                WHEN 9 THEN 'Everything for every household ' || p_partkey
                WHEN 10 THEN 'Everything for every household ' || p_partkey
                WHEN 11 THEN 'Everything for every household ' || p_partkey
                WHEN 12 THEN 'Everything for every household ' || p_partkey
                WHEN 13 THEN 'Everything for every household ' || p_partkey
                WHEN 14 THEN 'Everything for every household ' || p_partkey
                ELSE 'Shop/' || p_name || ' [' || p_type || ']: ' || p_brand
           END AS category_label""",
    )


def shop_listing(part: DataFrame) -> DataFrame:
    """Listing pages of a shop that sells the parts, chained by next-page links."""
    page_no = F.expr(f"p_partkey DIV {PAGE_SIZE} + 1")
    last = part.agg(F.max(page_no)).scalar()
    # Plain, nested, upper-case and unquoted markup in turn; a pod of another class is no product.
    forms = [
        ('<article class="product_pod"><h3>\n<a href="part-', '/index.html" title="x">'),
        ('<article class="old-product_pod"><h3><a href="gone">x</a></h3></article>'
         '<article class="wide product_pod"><h3><span></span><b><a title="x" href="part-',
         '/index.html">'),
        ("<ARTICLE CLASS='product_pod last'><H3><A HREF='part-", "/index.html'>"),
        ("<article class=product_pod><h3><a href=part-", "/index.html>"),
    ]
    turn = F.col("p_partkey") % len(forms)
    opened, closed = (
        F.element_at(F.array(*(F.lit(f[i]) for f in forms)), (turn + 1).cast("int")) for i in (0, 1)
    )
    pod = F.concat(
        opened, F.col("p_partkey").cast("string"), closed, "p_name", F.lit("</a></h3></article>")
    )
    # A page holds PAGE_SIZE parts, so the list is short.
    pods = F.array_sort(F.collect_list(F.struct("p_partkey", pod.alias("pod"))))
    pages = part.withColumn("page_no", page_no).groupBy("page_no").agg(pods.alias("pods"))
    html = F.concat(
        F.lit("<html><head><style>li.next a {}</style></head><body>"),
        F.lit('<!-- <article class="product_pod"><h3><a href="gone">x</a></h3></article>'),
        F.lit('<li class="next"><a href="gone.html">next</a></li> --><ol>'),
        F.array_join(F.transform("pods", lambda p: p["pod"]), "\n"),
        F.lit("</ol>"),
        F.when(
            F.col("page_no") < last,
            F.format_string(
                '<ul class="pager"><li class="next-steps"><a href="/help">help</a></li>'
                '<li class="next"><span><a href="page-%d.html">next</a></span></li></ul>',
                F.col("page_no") + 1,
            ),
        ).otherwise(F.lit("")),
        F.lit("</body></html>"),
    )
    url = F.format_string(f"{SHOP_ROOT}page-%d.html", "page_no")
    stored = pages.select(url.alias("url"), html.alias("html"))
    # Some pages are stored twice.
    return stored.unionByName(stored.where("hash(url) % 3 = 0"))


def shop_details(part: DataFrame) -> DataFrame:
    """Product pages of the same shop, with the faults of the raw offers.

    The parts are dealt out before pages are made of them: a file of parts is much smaller than its pages, and one task may
    read it all.
    """
    spread = int(part.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    o = offers_raw(part.repartition(spread))

    def block(before: str, column: str, after: str):
        whole = F.concat(F.lit(before), F.col(column), F.lit(after))
        return F.coalesce(whole, F.lit(""))

    html = F.concat(
        F.lit('<html><head><script>var fake = \'<div class="product_main"><h1>Fake</h1></div>\';</script></head>'),
        F.lit('<body><ul class="breadcrumb"><li><a href="/">Home</a><ul><li><a href="/n">New</a></ul></li>'),
        F.lit('<li><a href="/all">All &amp; more</a></li>'),
        block('<li><a href="/c">', "category", " &amp; Co</a></li>"),
        F.lit('<li class="active">x</li></ul><div class="col product_main"><div class="in"></div>'),
        F.lit('<!-- <h1>Old</h1><p class="price_color">£1.00</p> -->'),
        block("<h1>", "title", "</h1>"),
        F.when(F.col("price_text") == "n/a", F.lit("")).otherwise(
            block('<p class="price_color">', "price_text", "</p>")
        ),
        block(
            '<p class="instock availability">\n  <i class="icon-ok"></i>\n  ', "availability",
            "\n</p>",
        ),
        block('<p class="', "rating_class", '"><i></i></p>'),
        # Another product after the main block, with fields of its own.
        F.lit('</div><div class="recent"><article class="product_pod"><h1>Seen before</h1>'),
        F.lit('<p class="price_color">£9.99</p><p class="star-rating Two"></p>'),
        F.lit('<p class="availability">In stock (3 available)</p></article></div></body></html>'),
    )
    url = F.format_string(f"{SHOP_ROOT}part-%d/index.html", "ord")
    return o.select(url.alias("url"), html.alias("html"))


def page_bytes(pages: DataFrame) -> DataFrame:
    """page_id and the bytes of each page (as a column that is written as it is), every second one that allows it in ISO-8859-1."""
    western = (F.col("page_id") % 2 == 0) & ~F.col("html").rlike(r"[^\x00-\x7f\xa0-\xff]")
    declared = F.replace("html", F.lit('charset="utf-8"'), F.lit('charset="iso-8859-1"'))
    stored = F.when(western, F.encode(F.when(western, declared), "ISO-8859-1")).otherwise(F.col("html").cast("binary"))
    return pages.select("page_id", stored.cast("string").alias("value"))


def write_page_files(pages: DataFrame, path: str) -> None:
    """The rows of ``page_bytes`` as files ``page_id=<id>/part-<task>.txt`` below ``path``, each value ending in a line feed.

    Rows of one id that meet in a task share its file, as with Spark's own text writer, which writes on any file system. In a
    local or mounted folder that one starts several processes a page, to set the rights of its folder, its file and its checksum, so there
    tasks write the files themselves. A repeated task writes the same files anew.
    """
    hadoop = pages.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop.getFileSystem(pages.sparkSession._jsc.hadoopConfiguration()).makeQualified(hadoop).toUri()
    if uri.getScheme() != "file":
        pages.write.partitionBy("page_id").text(path)
        return
    root = uri.getPath()
    os.makedirs(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, out = f"part-{TaskContext.get().partitionId():05d}.txt", None, None
        try:
            for batch in batches:
                for key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    folder = f"{root}/page_id={NULL_FOLDER if key is None else key}"
                    if folder != held:
                        if out is not None:
                            out.close()
                        os.makedirs(folder, exist_ok=True)
                        held, out = folder, open(f"{folder}/{name}", "wb")
                    out.write((value or b"") + b"\n")
                yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["rows"])
        finally:
            if out is not None:
                out.close()

    rows = pages.select("page_id", F.col("value").cast("binary")).sortWithinPartitions("page_id")
    rows.mapInArrow(write, "rows bigint").write.format("noop").mode("overwrite").save()


def event_day(events: DataFrame) -> DataFrame:
    return events.withColumn("page_no", F.unix_date(F.col("ts").cast("date")).cast("bigint"))


def before_cut(events: DataFrame) -> DataFrame:
    return events.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))


def after_cut(events: DataFrame) -> DataFrame:
    return events.where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))


def event_items(events: DataFrame) -> DataFrame:
    """Events as items: the user and the JSON value name the category."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    price = F.col("value").cast(S.PRICE_SRC)
    return events.select(
        F.col("event_type").alias("title"),
        F.col("event_type").alias("title_src"),
        price.cast(S.PRICE).alias("price"),
        price.alias("price_src"),
        F.lit(None).cast("string").alias("rating_word"),
        F.lit(None).cast("int").alias("rating"),
        F.lit(None).cast("string").alias("availability"),
        k.alias("stock"),
        (k < 5).alias("low_stock"),
        F.concat_ws(" ", F.col("user_id").cast("string"), k.cast("string")).alias("category"),
        F.concat_ws(" ", F.col("user_id").cast("string"), k.cast("string")).alias(
            "category_label"
        ),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("url"),
        F.col("event_id").alias("ord"),
    )
