"""Records and links from markup as shops write it."""

import time

import pytest

from shopgrain.sources import pages as P

URL = "http://s.example/c/page-1.html"


def listing(spark, html):
    return spark.createDataFrame([(1, URL, html)], "page_no bigint, url string, html string")


def links(spark, html):
    return [u.removeprefix("http://s.example/c/") for u in P.page_links(listing(spark, html)).first().links]


POD = '<article class="product_pod"><h3><a href="a">x</a></h3></article>'


@pytest.mark.parametrize(
    "html, expected",
    [
        (POD + POD, ["a", "a"]),
        ("", []),
        ('<article class="old-product_pod"><h3><a href="a">x</a></h3></article>', []),
        ('<article class="product_pod-x"><h3><a href="a">x</a></h3></article>', []),
        ('<article class="x product_pod y"><h3><span></span><b><a href="a">x</a></b></h3></article>', ["a"]),
        ("<ARTICLE CLASS='product_pod'><H3><A TITLE=t HREF='a'>x</A></H3></ARTICLE>", ["a"]),
        ("<article class=product_pod><h3><a href=a>x</a></h3></article>", ["a"]),
        ('<article class="product_pod"><a href="no">x</a></article>' + POD, ["a"]),
        ('<article class="product_pod"><h3><a name="n">x</a></h3></article><h3><a href="no">x</a></h3>', []),
        ('<article class="product_pod"><h3><a href="a">x</a> <a href="b">y</a></h3></article>', ["a", "b"]),
        ('<article data-class="product_pod"><h3><a href="a">x</a></h3></article>', []),
        ("<!-- " + POD + " -->" + POD, ["a"]),
        ("<!-- > " + POD + " --" + POD, []),  # a comment that is never closed
        ("<!-->" + POD + "<!--->" + POD, ["a", "a"]),
        ("<script>'" + POD + "'</script><style>" + POD + "</style >" + POD, ["a"]),
        ("<SCRIPT src=x>" + POD + "</script\n>" + POD + "<script>" + POD, ["a"]),
        ("<script>// <!-- </script>" + POD + "<!-- <script> -->" + POD, ["a", "a"]),
        ("<scripts>" + POD + "</scripts>", ["a"]),
    ],
)
def test_product_links(spark, html, expected):
    assert links(spark, html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<li class="next"><a href="p2">n</a></li>', "p2"),
        ('<li class="next-steps"><a href="help">n</a></li>', None),
        ('<li class="next-steps"><a href="help">n</a></li><li class="next"><span><a href="p2">n</a></span></li>', "p2"),
        ("<LI CLASS=next><A HREF=p2>n</A></LI>", "p2"),
        ('<!--<li class="next"><a href="p9">n</a></li>--><li class="next"><a href="p2">n</a></li>', "p2"),
        ('<li class="next"><!--<a href="p9">n</a>--><a href="p2">n</a></li>', "p2"),
        ('<li class="next"></li><a href="no">x</a>', None),
        ("", None),
    ],
)
def test_next_page(spark, html, expected):
    found = P.next_pages(listing(spark, html)).first().next
    assert found == (expected and f"http://s.example/c/{expected}")


RECENT = """<div class="recent"><h1>Other</h1><p class="price_color">£9.99</p>
<p class="star-rating Two"></p><p class="availability">In stock (3 available)</p></div>"""


@pytest.mark.parametrize(
    "main, title, price, rating",
    [
        ("<h1>T</h1>", "T", None, None),
        ('<div><div></div></div><h1>T</h1><div><p class="price_color">£1.00</p></div>', "T", "£1.00", None),
        ("<H1>T</H1><P CLASS='big price_color'>£1.00</P><p class=\"star-rating One\">", "T", "£1.00", "star-rating One"),
        ('<h1>T</h1><p class="old_price_color">£1.00</p><p class="star-ratings One">', "T", None, None),
        ('<h1>T</h1><!-- <p class="price_color">£1.00</p> --><p class="price_color">£9.50</p>', "T", "£9.50", None),
        ('<h1><!-- x -->T<script>"y"</script></h1><style><p class="price_color">1</p></style>', "T", None, None),
    ],
)
def test_fields_come_from_the_main_block(spark, main, title, price, rating):
    for tag in ('<div class="col product_main">', "<DIV ID=x CLASS='product_main'>"):
        html = f"<div>{RECENT}{tag}{main}</div>{RECENT}</div>"
        row = P.product_texts(listing(spark, html)).first()
        assert (row.title, row.price_text, row.rating_class, row.availability) == (title, price, rating, None)


def test_a_main_block_in_a_script_is_none(spark):
    html = f"""<script>'<div class="product_main"><h1>Fake</h1></div>'</script>
    <div class="product_main"><h1>T</h1><p class="price_color">£1.00</p></div>{RECENT}"""
    row = P.product_texts(listing(spark, html)).first()
    assert (row.title, row.price_text) == ("T", "£1.00")


LINK = '<a href="/t">Travel</a>'


@pytest.mark.parametrize(
    "items, category",
    [
        (f"<li>1</li><li>2</li><li>{LINK}</li>", "Travel"),
        (f"<li>1<li>2<li>{LINK}", "Travel"),  # items need no end
        (f"<li>1<ul><li>x</li><li>y</li></ul></li><li>2</li><li>{LINK}</li>", "Travel"),
        (f"<li>1<ul><li>x<li>y</ul><li>2<li>{LINK}", "Travel"),
        (f"<li>1<ol><li>x<li>y<li><b><a>In</a></b></ol></li><li>2</li><li>{LINK}</li>", "In"),  # a third child too
        (f"<li>1</li><li>2</li><li>3</li><li>{LINK}</li>", None),
        (f"<li>1</li><li>{LINK}</li>", None),
        (f"<i></i><li>1</li><li>{LINK}</li>", "Travel"),  # children of any name count
        (f"<br><hr/><li><img src=x>{LINK}</li>", "Travel"),  # also those without content
        (f"<!-- <li>0</li> --><li>1</li><li>2</li><li>{LINK}</li>", "Travel"),
        (f"<li><a>1</a></li><li><a>2</a></li><li>3</li><a>4</a>", None),
        (f"<LI>1</LI><LI>2</LI><LI><SPAN><A HREF=x>Travel</A></SPAN></LI>", "Travel"),
        (f"<li>1</b></li></p><li>2</li><li>{LINK}</li>", "Travel"),  # ends of nothing
        ("<li>1</li><li>2</li><li>3 <ul><li><a>Deep</a></li></ul></li>", "Deep"),
        ("", None),
    ],
)
def test_the_category_is_the_link_in_a_third_child(spark, items, category):
    for opened in ('<ul class="breadcrumb">', "<UL CLASS='x breadcrumb'>"):
        html = f"<ul><li>1<li>2<li><a>no</a></ul>{opened}{items}</ul><ul><li>1<li>2<li><a>no</a></ul>"
        assert P.product_texts(listing(spark, html)).first().category == category


def test_no_main_block_gives_no_fields(spark):
    row = P.product_texts(listing(spark, RECENT.replace("recent", "product_main2"))).first()
    assert (row.title, row.price_text) == (None, None)


@pytest.mark.parametrize(
    "unit", ["<article ", '<article class="product ', "<div ", "<a href=", "<p class=", "<li class='next x", "</div>", " x",
     "<!--", "<script ", "<!-- -->", "<script></script>", "<ul class=breadcrumb>", "<ul class=breadcrumb><li>", "</ul>"]
)
def test_a_long_page_without_a_match_takes_linear_time(spark, unit):
    page = listing(spark, unit * (1_000_000 // len(unit)))
    began = time.time()
    assert P.page_links(page).first().links == [] and P.next_pages(page).first().next is None
    assert P.product_texts(page).first().title is None
    assert time.time() - began < 20
