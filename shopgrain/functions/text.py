"""Text normalisation and labels."""

from pyspark.sql import Column, functions as F

from shopgrain import fixed_values as V

# Unicode whitespace plus the four ASCII separator controls: as a pattern, and as characters, which
# trim without a pattern search.
WS = r"(?U)[\s\x1c-\x1f]"
WS_CHARS = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x) -> Column:
    """Drop whitespace of any kind at both ends."""
    return F.btrim(col(x), F.lit(WS_CHARS))


def blank_to_null(x) -> Column:
    """Stripped text, or null when nothing is left."""
    return F.nullif(strip_ws(x), F.lit(""))


def squeeze_ws(x) -> Column:
    return F.regexp_replace(col(x), rf"{WS}+", " ")


def slug(x) -> Column:
    """Dictionary key: lower case, whitespace runs to ``_``, other characters deleted."""
    joined = F.regexp_replace(F.lower(strip_ws(x)), rf"{WS}+", "_")
    return F.regexp_replace(joined, "[^a-z0-9_]+", "")


def table_name(x) -> Column:
    """Name that is safe as a table: ``[a-z0-9_]``, no leading digit, bounded length."""
    words = F.regexp_replace(F.lower(strip_ws(F.coalesce(col(x), F.lit("")))), "[^a-z0-9]+", "_")
    base = F.coalesce(F.nullif(F.btrim(words, F.lit("_")), F.lit("")), F.lit(V.FALLBACK_TABLE))
    named = F.when(base.rlike("^[0-9]"), F.concat(F.lit("t_"), base)).otherwise(base)
    return F.substring(named, 1, V.TABLE_NAME_CHARS)


def qualified_table_name(x, namespace: str, prefix: str) -> Column:
    return F.concat(F.lit(f"{namespace}.{prefix}"), table_name(x))


def sheet_base_name(x) -> Column:
    """Sheet name before clashes are resolved."""
    legal = F.regexp_replace(strip_ws(F.coalesce(col(x), F.lit(""))), r"[:\\/?*\[\]]+", " ")
    named = F.coalesce(blank_to_null(squeeze_ws(legal)), F.lit(V.FALLBACK_SHEET))
    return F.substring(named, 1, V.SHEET_NAME_CHARS)


def or_missing(x) -> Column:
    """Null or empty text shown as the missing mark."""
    return F.coalesce(F.nullif(col(x), F.lit("")), F.lit(V.MISSING))


def price_label(price, symbol: str = V.PRICE_SYMBOL) -> Column:
    text = col(price).cast("decimal(29,2)").cast("string")
    return F.coalesce(F.concat(F.lit(f"{symbol} "), text), F.lit(V.MISSING))


def number_label(x) -> Column:
    return F.coalesce(col(x).cast("string"), F.lit(V.MISSING))


def flag_label(x) -> Column:
    return F.when(col(x), F.lit(V.YES)).otherwise(F.lit(V.NO))


def one_line(x) -> Column:
    return strip_ws(F.replace(col(x), F.lit("\n"), F.lit(" ")))


def capture_line(ord_, limit: int = 0, symbol: str = V.PRICE_SYMBOL) -> Column:
    """Report line of one item row; with no limit the ordinal itself is shown as the total."""
    shown_limit = F.lit(limit).cast("bigint") if limit > 0 else col(ord_)
    return F.format_string(
        V.CAPTURE_LINE,
        col(ord_),
        shown_limit,
        or_missing("title"),
        price_label("price", symbol),
        number_label("rating"),
        or_missing("rating_word"),
        one_line(or_missing("availability")),
        number_label("stock"),
        flag_label("low_stock"),
        or_missing("category"),
    )


def rate_line(rate) -> Column:
    """Rate with four decimals, or the notice that there is none."""
    shown = col(rate).cast("decimal(18,4)").cast("string")
    known = col(rate).isNotNull() & (col(rate) != 0)
    return F.when(known, F.format_string(V.RATE_LINE, shown)).otherwise(F.lit(V.NO_RATE_LINE))


def run_stamp(ts) -> Column:
    return F.date_format(col(ts), "yyyyMMdd_HHmmss")
