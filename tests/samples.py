"""Items and shop pages for the tests of whole jobs."""

from decimal import Decimal

from shopgrain import schema as S


def item(ord_, title, price, stock, category, label, url):
    return (
        title, title, Decimal(price) if price else None, None, None, None, None, stock,
        stock is not None and stock < 5, category, label, url, ord_,
    )


FIRST = [
    item(1, "a", "1.00", 1, "Art", "arte", "u1"),
    item(2, "b", "3.00", 9, "Art", "arte", "u2"),
    item(3, "c", "5.00", 9, "Travel", "viagem", "u3"),
    item(4, "d", None, None, None, None, "u4"),
    item(5, "e", "2.00", 2, " ", " ", "u5"),
    item(6, "b again", "9.00", 2, "Art", "arte", "u2"),
    item(7, "keyless", "9.00", 2, "Art", "arte", None),
    item(8, "empty key", "9.00", 2, "Art", "arte", ""),
]
SECOND = [
    item(1, "a changed", "100.00", 1, "Art", "arte", "u1"),
    item(2, "new", "7.00", 1, "Art", "arte", "u9"),
    item(3, "moved", "5.00", 9, "Poetry", "poesia", "u3"),
]


def items(spark, rows):
    return spark.createDataFrame(rows, S.ITEM)


def listing_page(n, links, last):
    pods = "".join(
        f'<article class="product_pod"><h3><a href="{link}">x</a></h3></article>' for link in links
    )
    onward = "" if last else f'<li class="next"><a href="page-{n + 1}.html">next</a></li>'
    return (n, f"http://s.example/c/page-{n}.html", f"<html>{pods}{onward}</html>")


def detail_page(name, title, price, category, rating, stock):
    return (
        f"http://s.example/c/{name}.html",
        f"""<ul class="breadcrumb"><li><a>Home</a></li><li><a>All</a></li><li><a>{category}</a></li>
        </ul><div class="product_main"><h1>{title}</h1><p class="price_color">{price}</p>
        <p class="instock availability">In stock ({stock} available)</p>
        <p class="star-rating {rating}"></p></div>""",
    )
