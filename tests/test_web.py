import html
from urllib.parse import quote, urljoin

import pytest
from pyspark.sql import functions as F
from shopgrain.functions import web
from shopgrain.sources.pages import (
    next_pages,
    page_fields,
    page_links,
    pages_from_files,
    product_records,
    product_texts,
)
from tests.helpers import apply, random_strings

BASES = [
    "http://h.example", "http://h.example/", "http://h.example/a/b/c.html", "https://h.example/a/?q=1#f",
    "http://h.example/a//b/", "http://h.example/fr/825?page=2&ref=x",
]
HREFS = [
    "", "x", "x/", "x/y.html?z=1#w", "./x", "../x", "../../../x", "..", ".", "../", "a/./b/../c", "/x",
    "/x/../y", "/../x", "/a//b", "?p=2", "#top", "#", "//other.example/z", "https://o.example/a/../b",
    "mailto:a@b", "x?", "a/..", "/.", "x//y",
    "http:g", "http:", "http:/g", "http:?q", "https:g", "HTTP:g", "//", "///x", "//?q", "///", "//o.example", "HTTP://o.example/",
    "HTTPS://O.example/x?", "?", "?#f", "#f", "/?", "g:h", "g:h?", "HTTP://o.example", "//o.example/..//x",
]


def test_links_resolve_like_a_browser(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    rows = spark.createDataFrame(pairs, "base string, href string").select(
        "base", "href", web.resolve_link("base", "href").alias("url")
    )
    wrong = [(r.base, r.href, r.url, urljoin(r.base, r.href)) for r in rows.collect()
             if r.url != urljoin(r.base, r.href)]
    assert wrong == []


def test_quoting(spark):
    keys = ["a b", "a/b", "~x*y+z", "é日", "100%", "'(!)'"] + random_strings(200, seed=3)
    assert apply(spark, keys, web.quote_key) == [quote(k) for k in keys]


def test_character_references(spark):
    texts = [
        "a &amp; b", "&amp;lt;", "&lt;&gt;&quot;&apos;&#39;&#x27;", "&pound;5 &copy; &middot;",
        "&#233;&#x1F600;&eacute;", "&unknown; & &;", "&#38;lt; &#038;amp;", "plain", "",
    ]
    assert apply(spark, texts, web.decode_entities) == [html.unescape(t) for t in texts]
    assert apply(spark, ["&#0;", "&#xD800;", None], web.decode_entities) == ["�", "�", None]


def test_element_text(spark):
    texts = {
        "\n  <i class='x'></i>\n In   stock\n (3 available)\n": "In stock (3 available)",
        "a<br>b <br/> c": "a\nb\nc", "<b></b>": None, "": None, "&nbsp; x &nbsp;": "x",
    }
    assert apply(spark, list(texts), lambda x: web.decoded(web.bare_text(x))) == list(texts.values())


LISTING = """<ol><li><article class="product_pod"><div><a href="wrong">i</a></div>
<h3><a title="t" href="one_1/index.html">One</a></h3></article></li>
<article class="x product_pod"><h3><a href=" ../two?a=1&amp;b=2 ">Two</a></h3></article>
<article class="product_pod"><h3><a href="">none</a></h3></article>
<article class="product_pod"><h3><a href="one_1/index.html">Again</a></h3></article></ol>
<ul class="pager"><li class="previous"><a href="page-0.html">p</a></li>
<li class="next"><a href="page-2.html">next</a></li></ul>"""

DETAIL = """<ul class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/b">Books</a></li>
<li> <a href="/p">Food &amp; Drink</a></li><li class="active">T</li></ul>
<h1>not this one</h1><div class="col-sm-6 product_main"><h1> A <em>Title</em> </h1>
<p class="price_color">£51.77</p><p class="instock availability"><i class="icon-ok"></i>
 In stock (4 available) </p><p class="star-rating Three"><i></i></p></div>"""


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_no bigint, url string, html string")


def test_listing_page(spark):
    df = pages(spark, (1, "http://s.example/c/page-1.html", LISTING), (2, "http://s.example/c/", "x"))
    links = {r.page_no: r.links for r in page_links(df).collect()}
    one = "http://s.example/c/one_1/index.html"
    assert links == {1: [one, "http://s.example/two?a=1&b=2", one], 2: []}
    chain = {r.node: r.next for r in next_pages(df).collect()}
    assert chain == {
        "http://s.example/c/page-1.html": "http://s.example/c/page-2.html", "http://s.example/c/": None,
    }


def test_detail_page(spark):
    df = pages(spark, (None, "u", DETAIL), (None, "empty", "<html></html>"))
    found = {r.url: r for r in product_records(product_texts(df)).collect()}
    u = found["u"]
    assert (u.title_src, str(u.price_src), u.rating_word, u.rating) == ("A Title", "51.7700", "Three", 3)
    assert (u.availability, u.stock, u.low_stock) == ("In stock (4 available)", 4, True)
    assert u.category == "Food & Drink"
    blank = found["empty"].asDict()
    assert blank.pop("url") == "empty" and blank.pop("low_stock") is False
    assert set(blank.values()) == {None}


def test_third_breadcrumb_must_be_a_link(spark):
    short = DETAIL.replace("<li> <a href=\"/p\">Food &amp; Drink</a></li>", "")
    texts = product_texts(pages(spark, (1, "u", short))).first()
    assert texts.category is None


def test_named_fields_drop_the_html(spark):
    df = page_fields(
        pages(spark, (1, "u", '<html lang=" en "><h1>a &lt; b</h1>')),
        {"h1": "(?s)<h1>(.*?)</h1>", "h2": "<h2>(.*?)</h2>"},
        {"lang": '<html lang="([^"]*)"'},
    )
    assert df.columns == ["page_no", "url", "h1", "h2", "lang"]
    assert tuple(df.first()) == (1, "u", "a < b", None, "en")


def test_long_pages_are_searched_whole(spark):
    filler = "<p class='x'>y</p>\n" * 200_000
    df = spark.range(1).select(
        F.lit(1).alias("page_no"), F.lit("u").alias("url"),
        F.concat(F.lit(filler), F.lit(DETAIL), F.lit(filler)).alias("html"),
    )
    assert product_texts(df).first().title == "A Title"


WESTERN = "caf\xe9 \u20ac5 \u2018q\u2019 \u0160"


@pytest.mark.parametrize(
    "content, text",
    [
        ('<meta charset="utf-8">é日'.encode(), '<meta charset="utf-8">é日'),
        ("é日".encode(), "é日"),  # nothing declared
        ('<META CHARSET=ISO-8859-1>'.encode() + WESTERN.encode("cp1252"), "<META CHARSET=ISO-8859-1>" + WESTERN),
        (b"<meta charset='windows-1252'/>\xe9\x80", "<meta charset='windows-1252'/>é€"),
        (b'<meta http-equiv="Content-Type" content="text/html; charset=latin1">\xe9',
         '<meta http-equiv="Content-Type" content="text/html; charset=latin1">é'),
        (b'\xef\xbb\xbf<meta charset="latin1">' + "é".encode(), '<meta charset="latin1">é'),  # the mark wins
        (b'<meta charset="utf-8">a\xe9b', '<meta charset="utf-8">a\ufffdb'),
        (b"<p charset=latin1>" + "é".encode(), "<p charset=latin1>é"),
        (b'<meta name="x" data-charset="latin1">' + "é".encode(), '<meta name="x" data-charset="latin1">é'),
        (b" " * 1100 + b"<meta charset=latin1>" + "é".encode(), " " * 1100 + "<meta charset=latin1>é"),
        (b'<meta charset="klingon">' + "é".encode(), '<meta charset="klingon">é'),
        (b"", ""),
        (None, None),
    ],
)
def test_pages_are_read_in_the_set_they_declare(spark, content, text):
    row = spark.createDataFrame([(content,)], "content binary").select(web.page_text("content").alias("t")).first()
    assert row.t == text


def test_pages_from_files(spark, tmp_path):
    for name, content in {"a/x=1/p.html": "é".encode(), "a/x=2/q.html": b"<meta charset=latin1>\xe9", "a/x=2/r.txt": b"no"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    found = pages_from_files(spark, str(tmp_path / "a"), "*.html")
    rows = {r.file.rsplit("/", 1)[1]: (r.html, r.x) for r in found.collect()}
    assert rows == {"p.html": ("é", 1), "q.html": ("<meta charset=latin1>é", 2)}
