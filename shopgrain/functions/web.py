"""Page text, link resolution and query encoding."""

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from shopgrain.functions.text import blank_to_null, col, squeeze_ws, strip_ws

REFERENCE = "&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
COMMON_NAMES = ("amp", "lt", "gt", "quot", "nbsp")  # first, because a map is searched in order
REFERENCE_CODES = {n: name2codepoint[n] for n in COMMON_NAMES} | {"apos": 39} | name2codepoint
SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
CHARSET = r"""(?i)<meta[^>]*?[\s"';]charset\s*=\s*["']?\s*([^\s"'/>;]+)"""
# fixed values: the names of the western sets, and what windows-1252 has in place of control characters
WESTERN = "iso-8859-1 iso8859-1 latin1 l1 windows-1252 cp1252 us-ascii ascii".split()
WINDOWS_1252 = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f",
    "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ",
)
OPAQUE = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"
    r"|<(script|style)(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*>|\z)"
)


def decode_entities(x) -> Column:
    """Character references, by number or by name, as the characters they stand for.

    The text is cut at its references and put together again with each one decoded, so what one
    reference gives is never read as part of another. An unknown name stays as it is.
    """
    text = col(x)
    refs = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))
    chars = F.zip_with(refs, F.transform(refs, _reference_code), _character)
    joined = F.zip_with(
        F.split(text, REFERENCE), chars, lambda t, c: F.concat(t, F.coalesce(c, F.lit("")))
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(joined, "")).otherwise(text)


def _reference_code(ref: Column) -> Column:
    """Code point of a reference like ``#233``, ``#xE9`` or ``eacute``; null for an unknown name."""
    codes = ",".join(f"{name}:{code}" for name, code in REFERENCE_CODES.items())
    named = F.str_to_map(F.lit(codes), F.lit(","), F.lit(":"))
    digits = F.regexp_replace(ref, "^#[xX]?0*", "")
    # No code point has more digits than that; more of them stand for no character.
    hexadecimal = F.when(F.length(digits) <= 6, F.conv(digits, 16, 10)).otherwise(F.lit("-1"))
    decimal = F.when(F.length(digits) <= 7, F.concat(F.lit("0"), digits)).otherwise(F.lit("-1"))
    return (
        F.when(ref.startswith("#x") | ref.startswith("#X"), F.coalesce(hexadecimal, F.lit("0")))
        .when(ref.startswith("#"), decimal)
        .otherwise(F.try_element_at(named, ref))
        .try_cast("int")
    )


def _character(ref: Column, code: Column) -> Column:
    legal = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(legal, code).otherwise(F.lit(0xFFFD))), 8, "0"))
    unknown = F.concat(F.lit("&"), ref, F.lit(";"))
    return F.when(code.isNull(), unknown).otherwise(F.decode(utf32, "UTF-32"))


def bare_text(inner_html) -> Column:
    """Text of an element: tags gone, whitespace squeezed, breaks as new lines."""
    lines = F.regexp_replace(squeeze_ws(inner_html), r"(?i) ?<br\s*/?> ?", "\n")
    return F.regexp_replace(lines, "<[^>]*>", "")


def decoded(x) -> Column:
    """Text as shown, its character references decoded; null when nothing is left.

    The text is looked at several times: select it as a column of its own before.
    """
    return blank_to_null(decode_entities(x))


def first_match(html, pattern: str) -> Column:
    """Group 1 of the first match, empty when there is none.

    Select it as a column of its own before it is cleaned, so the page is searched once.
    """
    return F.regexp_extract(col(html), pattern, 1)


def all_attributes(html, pattern: str) -> Column:
    """Every match's group 1 in document order, stripped, empty ones dropped, copies kept."""
    return link_targets(F.regexp_extract_all(col(html), F.lit(pattern), F.lit(1)))


def link_targets(found: Column) -> Column:
    """Raw attribute values as links: decoded, stripped, empty ones dropped."""
    cleaned = F.transform(found, lambda href: strip_ws(decode_entities(href)))
    return F.filter(cleaned, lambda href: href != "")


def quote_key(x) -> Column:
    """Percent-encode for a query string; ``/`` stays as it is."""
    text = F.url_encode(col(x))
    for encoded, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        text = F.replace(text, F.lit(encoded), F.lit(plain))
    return text


def declared_charset(content) -> Column:
    """The character set that a page's bytes name in their first 1024, in lower case; empty without one."""
    head = F.decode(F.substring(col(content), 1, 1024), "ISO-8859-1")
    return F.lower(F.regexp_extract(head, CHARSET, 1))


def page_text(content) -> Column:
    """A page's bytes as text: by a byte order mark, else by the declared character set, else UTF-8.

    Western single-byte sets are read as browsers do, as windows-1252. What is no UTF-8 becomes replacement characters, so no page
    fails.
    """
    raw = col(content)
    marked = F.substring(raw, 1, 3) == F.lit(b"\xef\xbb\xbf")
    utf8 = F.make_valid_utf8(F.when(marked, F.substring(raw, 4, 1 << 30)).otherwise(raw).cast("string"))
    western = F.translate(F.decode(raw, "ISO-8859-1"), *WINDOWS_1252)
    return F.when(~marked & declared_charset(raw).isin(*WESTERN), western).otherwise(utf8)


def shown_markup(html) -> Column:
    """The page without what a reader never sees: comments, scripts and styles, also unclosed ones, from left to right."""
    return F.regexp_replace(col(html), OPAQUE, "")


def resolve_link(base, href) -> Column:
    """Absolute form of ``href`` as found on the page at ``base``.

    A link with the page's own scheme is read like one without, a link with another one stays as it is.
    """
    base, href = col(base), col(href)
    scheme = F.lower(F.regexp_extract(base, rf"^({SCHEME}):", 1))
    own = F.lower(F.regexp_extract(href, rf"^({SCHEME}):", 1))
    after = F.when(own == scheme, F.regexp_replace(href, rf"^{SCHEME}:", "")).otherwise(href)
    rest = F.regexp_replace(after, r"^//(?=[/?#]|$)", "")  # without a host it is a path
    origin = F.concat(scheme, F.regexp_extract(base, rf"^{SCHEME}(://[^/?#]*)", 1))
    base_path = F.regexp_extract(base, rf"^{SCHEME}://[^/?#]*([^?#]*)", 1)
    base_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    folder = F.coalesce(
        F.nullif(F.regexp_replace(base_path, r"[^/]*$", ""), F.lit("")), F.lit("/")
    )
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    tail = F.regexp_extract(rest, r"(?s)^[^?#]*(.*)$", 1)
    below_folder = F.regexp_replace(F.concat(folder, path), "/+", "/")
    resolved = (
        F.when(rest.startswith("//"), F.concat(scheme, F.lit(":"), rest))
        .when(rest.rlike(r"^\?[^#]"), F.concat(origin, base_path, rest))
        .when(path == "", F.concat(origin, base_path, base_query, F.regexp_replace(rest, r"^\?", "")))
        .when(path.startswith("/"), F.concat(origin, _without_dots(path), tail))
        .otherwise(F.concat(origin, _without_dots(below_folder), tail))
    )
    ended = F.regexp_replace(F.regexp_replace(resolved, r"^([^?#]*)\?(#|$)", "$1$2"), "#$", "")
    foreign = (own != "") & (own != scheme)
    return F.when(href == "", base).when(foreign, href).otherwise(ended)


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        )
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_in_folder = F.element_at(segments, -1).isin(".", "..")
    last = F.when(ends_in_folder, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    joined = F.array_join(F.concat(kept, last), "/")
    absolute = F.concat(F.lit("/"), F.regexp_replace(joined, "^/", ""))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), absolute).otherwise(path)
