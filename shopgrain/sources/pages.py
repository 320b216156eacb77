"""Records and links from a table of raw pages ``(page_no, url, html)``.

Elements are found by fixed patterns whose group 1 is the wanted text, in what a reader sees of the page: comments, scripts and
styles are taken out first. All columns of a page come from one projection, so ``html`` is read once and dropped
before anything is shuffled.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopgrain.functions.parse import (
    low_stock,
    price_number,
    rating_number,
    rating_word,
    stock_count,
)
from shopgrain.functions.text import blank_to_null
from shopgrain.functions.web import (
    bare_text,
    decoded,
    first_match,
    link_targets,
    page_text,
    resolve_link,
    shown_markup,
)


def _opening(tag: str) -> str:
    """Where an element of this name begins."""
    return rf"(?i)<{tag}(?=[\s/>])"


def _closing(tag: str) -> str:
    return rf"(?i)</{tag}(?=[\s>])"


def _attribute(name: str, value: str) -> str:
    """The rest of an opening tag up to an attribute's value; no tag holds another tag's begin."""
    return rf"[^<>]*?\s(?i:{name})\s*=\s*{value}"


def _token(name: str) -> str:
    """A class list with a whole token, with or without quotes."""
    return (
        rf"""(?:"(?:[^"<>]*\s)?{name}(?:\s[^"<>]*)?"|'(?:[^'<>]*\s)?{name}(?:\s[^'<>]*)?'"""
        rf"""|{name}(?=[\s>]))"""
    )


def _tag_with_class(tag: str, name: str) -> str:
    return rf"<(?i:{tag})(?=\s){_attribute('class', _token(name))}[^<>]*>"


# fixed values: elements without content, and how deep browsers nest
VOID_ELEMENTS = "area base br col embed hr img input link meta param source track wbr".split()
MOST_DEPTH = 512
OPEN = "array<struct<name:string,children:int>>"

ANCHOR = r"""(?i)<a(?=\s)[^<>]*?\shref\s*=\s*("[^"<>]*"|'[^'<>]*'|[^\s"'<>]+)"""


@dataclass(frozen=True)
class PagePatterns:
    """Where a shop keeps its fields. The defaults fit the usual product-pod markup.

    An element is given by its tag and a class that is one whole token of its class list. Texts are
    patterns whose group 1 is wanted.
    """

    product: tuple[str, str] = ("article", "product_pod")
    product_heading: str = "h3"
    next_item: tuple[str, str] = ("li", "next")
    main: tuple[str, str] = ("div", "product_main")
    title: str = r"(?is)<h1(?=[\s>])[^>]*>(.*?)</h1"
    price: str = r"(?s)" + _tag_with_class("p", "price_color") + r"(.*?)</(?i:p)"
    availability: str = r"(?s)" + _tag_with_class("p", "availability") + r"(.*?)</(?i:p)"
    rating_class: str = r"<(?i:p)(?=\s)" + _attribute(
        "class", "(" + _token("star-rating").removeprefix("(?:")
    )
    breadcrumb: tuple[str, str] = ("ul", "breadcrumb")
    breadcrumb_item: str = "li"
    category_position: int = 3  # among the children of the item's parent
    category_link: str = r"(?is)<a(?=[\s>])[^>]*>(.*?)</a"


SHOP = PagePatterns()


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` looks at it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _elements(html: Column, tag: str, token: str | None = None) -> Column:
    """Inner texts of a page's elements, up to their close or the next element of the same name.

    The page is cut at the element's begins, so the work is linear in the page's length.
    """
    begins = F.split(html, _opening(tag))
    pieces = F.slice(begins, F.lit(2), F.greatest(F.size(begins) - 1, F.lit(0)))
    if token is not None:
        wanted = "^" + _attribute("class", _token(token))
        pieces = F.filter(pieces, lambda piece: piece.rlike(wanted))
    return F.transform(pieces, lambda piece: F.get(F.split(piece, _closing(tag), 2), F.lit(0)))


def _anchors(inner: Column) -> Column:
    """Link targets in document order, without their quotes."""
    quoted = F.regexp_extract_all(inner, F.lit(ANCHOR), F.lit(1))
    return F.transform(quoted, lambda href: F.regexp_replace(href, "^[\"']|[\"']$", ""))


def _main_block(html: Column, tag: str, token: str) -> Column:
    """Inner text of the first element with the class, up to its own close; null without one.

    The page is cut before each begin and end of such elements; from the wanted one on, depth is
    counted until it is back at none.
    """
    wanted = rf"(?s)^{_tag_with_class(tag, token)}"
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("kept"), F.lit(False).alias("closed"))

    def step(state: Column, piece: Column) -> Column:
        ends = piece.startswith("</")
        depth = state["depth"] + F.when(ends, -1).otherwise(1)
        closed = state["closed"] | (depth <= 0)
        kept = state["kept"] + F.when(closed, 0).otherwise(1)
        return F.struct(depth.alias("depth"), kept.alias("kept"), closed.alias("closed"))

    def up_to_close(tail: Column) -> Column:
        return F.array_join(F.slice(tail, F.lit(1), F.aggregate(tail, start, step)["kept"]), "")

    def from_first(pieces: Column) -> Column:
        first = F.array_position(F.transform(pieces, lambda piece: piece.rlike(wanted)), True)
        return _once(
            first.cast("int"),
            lambda at: F.when(at > 0, _once(F.slice(pieces, at, F.size(pieces)), up_to_close)),
        )

    return _once(F.split(html, rf"(?i)(?=<{tag}[\s/>]|</{tag}[\s>])"), from_first)


def _link_in_child(block: Column, tag: str, place: int) -> Column:
    """What follows from the first link within a ``tag`` that is child number ``place`` of its parent; null without one.

    One pass over the block's tags with a stack of the open elements and the number of children each has had. An element
    closes what is still open inside it, and an item the item before it in the same list. As in browsers, elements
    nested deeper than ``MOST_DEPTH`` count as siblings.
    """
    root = F.array(F.struct(F.lit("").alias("name"), F.lit(0).alias("children")))
    none = F.lit(0).cast("bigint")
    start = F.struct(root.alias("open"), *(none.alias(n) for n in ("at", "within", "found")))

    def tag_of(piece: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, r"^</?([A-Za-z][^\s/>]*)", 1))
        return F.struct(name.alias("name"), piece.startswith("</").alias("closes"))

    def closed_by(piece: Column, from_top: Column) -> Column:
        """How many open elements a tag closes, of their names from the innermost outwards."""
        name = piece["name"]
        item = F.array_position(from_top, tag)
        lists = [F.array_position(from_top, x) for x in ("ul", "ol")]
        in_this_list = F.lit(True)
        for each in lists:
            in_this_list &= (each == 0) | (item < each)
        return (
            F.when(piece["closes"], F.array_position(from_top, name))
            .when((name == tag) & in_this_list, item)
            .otherwise(F.lit(0))
        )

    def after(state: Column, piece: Column, kept: Column) -> Column:
        name = piece["name"]
        opens = (name != "") & ~piece["closes"]
        depth = F.size(kept)
        parent = F.element_at(kept, -1)
        counted = F.struct(parent["name"].alias("name"), (parent["children"] + 1).alias("children"))
        own = F.struct(name.alias("name"), F.lit(0).alias("children"))
        inner = F.when(name.isin(*VOID_ELEMENTS) | (depth >= MOST_DEPTH), F.array().cast(OPEN))
        grown = F.concat(F.slice(kept, F.lit(1), depth - 1), F.array(counted), inner.otherwise(F.array(own)))
        still = F.when(depth >= state["within"], state["within"]).otherwise(none)
        begins = opens & (name == tag) & (parent["children"] + 1 == place) & (still == 0)
        hit = opens & (name == "a") & (still > 0) & (state["found"] == 0)
        return F.struct(
            F.when(opens, grown).otherwise(kept).cast(OPEN).alias("open"),
            (state["at"] + 1).alias("at"),
            F.when(begins, (depth + 1).cast("bigint")).otherwise(still).alias("within"),
            F.when(hit, state["at"] + 1).otherwise(state["found"]).alias("found"),
        )

    def step(state: Column, piece: Column) -> Column:
        closed = _once(F.reverse(state["open"]["name"]), lambda from_top: closed_by(piece, from_top))
        kept = F.slice(state["open"], F.lit(1), (F.size(state["open"]) - closed).cast("int"))
        return _once(kept, lambda kept: after(state, piece, kept))

    def link(pieces: Column) -> Column:
        zero = start.cast(f"struct<open:{OPEN},at:bigint,within:bigint,found:bigint>")
        found = F.aggregate(F.transform(pieces, tag_of), zero, step)["found"]
        return _once(
            found.cast("int"),
            lambda at: F.when(at > 0, F.array_join(F.slice(pieces, at, F.size(pieces)), "")),
        )

    return _once(F.split(block, r"(?=</?[A-Za-z])"), link)


def _shown_pages(pages: DataFrame) -> DataFrame:
    """The pages with their markup as a reader sees it; a projection of its own, so that it is worked out once."""
    return pages.withColumn("html", shown_markup("html"))


def pages_from_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``file`` (its path), ``html`` and the columns of partition folders of all pages stored below a path.

    A file is one page as a crawler left it, in the character set it declares.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    folders = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.select(F.col("path").alias("file"), page_text("content").alias("html"), *folders)


def page_links(pages: DataFrame, patterns: PagePatterns = SHOP) -> DataFrame:
    """Product links per listing page, absolute, in document order, copies kept."""
    cut = _shown_pages(pages).select(
        "page_no",
        F.col("url").alias("page_url"),
        _elements(F.col("html"), *patterns.product).alias("products"),
    )
    headings = F.flatten(
        F.transform("products", lambda p: _elements(p, patterns.product_heading))
    )
    hrefs = link_targets(F.flatten(F.transform(headings, _anchors)))
    links = F.transform(hrefs, lambda href: resolve_link(F.col("page_url"), href))
    return cut.select("page_no", "page_url", F.coalesce(links, F.array()).alias("links"))


def next_pages(pages: DataFrame, patterns: PagePatterns = SHOP) -> DataFrame:
    """Chain of listing pages: ``(node, next)``, next null at the end."""
    onward = F.flatten(F.transform(_elements(F.col("html"), *patterns.next_item), _anchors))
    raw = _shown_pages(pages).select("url", F.get(onward, F.lit(0)).alias("raw"))
    hrefs = raw.select("url", decoded("raw").alias("href"))
    return hrefs.select(F.col("url").alias("node"), resolve_link("url", "href").alias("next"))


def page_fields(pages: DataFrame, texts: dict[str, str], attributes: dict[str, str]) -> DataFrame:
    """Named element texts and attributes beside the page's own columns, without ``html``."""
    found = {k: first_match("html", p) for k, p in {**texts, **attributes}.items()}
    kept = [c for c in pages.columns if c != "html"]
    raw = _shown_pages(pages).select(*kept, *(c.alias(k) for k, c in found.items()))
    return _shown(raw, [*texts], kept)


def product_texts(pages: DataFrame, patterns: PagePatterns = SHOP) -> DataFrame:
    """Raw texts of one product per detail page; a missing element gives null."""
    blocks = _shown_pages(pages).select(
        "url",
        _main_block(F.col("html"), *patterns.main).alias("main"),
        _main_block(F.col("html"), *patterns.breadcrumb).alias("breadcrumb"),
    )
    crumb = _link_in_child(
        F.col("breadcrumb"), patterns.breadcrumb_item, patterns.category_position
    )
    raw = blocks.select("url", "main", crumb.alias("crumb")).select(
        "url",
        first_match("main", patterns.title).alias("title"),
        first_match("main", patterns.price).alias("price_text"),
        F.regexp_replace(first_match("main", patterns.rating_class), "^[\"']|[\"']$", "").alias(
            "rating_class"
        ),
        first_match("main", patterns.availability).alias("availability"),
        first_match("crumb", patterns.category_link).alias("category"),
    )
    return _shown(raw, ["title", "price_text", "availability", "category"], ["url"])


def _shown(raw: DataFrame, texts: list[str], kept: list[str]) -> DataFrame:
    """Element texts and attributes as a reader sees them; one projection per step, so that no step
    is worked out twice."""
    bare = raw.withColumns({k: bare_text(k) for k in texts})
    return bare.select(*kept, *(decoded(k).alias(k) for k in raw.columns if k not in kept))


def clean_texts(offers: DataFrame) -> DataFrame:
    """Offer texts as an element lookup would give them: stripped, null when empty."""
    texts = ("title", "price_text", "rating_class", "availability", "category")
    return offers.withColumns({c: blank_to_null(c) for c in texts})


def product_records(texts: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed product fields from raw texts, beside the ``extra`` columns."""
    worded = texts.withColumns(
        {
            "price_src": price_number("price_text"),
            "rating_word": rating_word("rating_class"),
            "stock": stock_count("availability"),
        }
    )
    return worded.select(
        *extra,
        "url",
        F.col("title").alias("title_src"),
        "price_src",
        "rating_word",
        rating_number("rating_word").alias("rating"),
        "availability",
        "stock",
        low_stock("stock").alias("low_stock"),
        "category",
    )
