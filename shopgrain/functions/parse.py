"""Raw text to typed values. Unusable text gives null, never an error."""

from pyspark.sql import Column, functions as F

from shopgrain import fixed_values as V
from shopgrain import schema as S
from shopgrain.functions.text import blank_to_null, col, strip_ws


def price_number(x) -> Column:
    """Plain decimal text, with an optional pound sign and a comma or dot as the decimal mark."""
    unsigned = F.replace(F.replace(col(x), F.lit("£"), F.lit("")), F.lit(","), F.lit("."))
    text = strip_ws(unsigned)
    return F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), text).try_cast(S.PRICE_SRC)


def stock_count(x) -> Column:
    """The number in ``(N available)``."""
    digits = F.regexp_extract(col(x), r"(?U)\(([0-9]+)\s+available\)", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def rating_word(css_class) -> Column:
    """First token of a class list that is a rating word (case-sensitive)."""
    words = "|".join(V.RATING_NUMBERS)
    token = r"(?U)(?:^|[\s\x1c-\x1f])(" + words + r")(?![^\s\x1c-\x1f])"
    return F.nullif(F.regexp_extract(col(css_class), token, 1), F.lit(""))


def rating_number(word) -> Column:
    pairs = [F.lit(v) for kv in V.RATING_NUMBERS.items() for v in kv]
    return F.try_element_at(F.create_map(*pairs), col(word))


def low_stock(stock, threshold: int = V.LOW_STOCK_BELOW) -> Column:
    return F.coalesce(col(stock) < F.lit(threshold), F.lit(False))


def converted_price(price_src, rate) -> Column:
    """Price at the run's rate, to two places half up; the source price when there is no rate."""
    known = col(price_src).isNotNull() & col(rate).isNotNull() & (col(rate) != 0)
    at_rate = F.round(col(price_src) * col(rate).cast(S.RATE), 2)
    return F.when(known, at_rate.try_cast(S.PRICE)).otherwise(
        F.round(col(price_src), 2).try_cast(S.PRICE)
    )


def rate_from_json(payload, currency: str = "BRL") -> Column:
    """``rates.<currency>`` as a positive number, else null."""
    rate = F.get_json_object(col(payload), f"$.rates.{currency}").try_cast(S.RATE)
    return F.when(rate > 0, rate)


def translation_from_json(payload) -> Column:
    """``responseData.translatedText``, stripped; null when absent, blank or not JSON."""
    return blank_to_null(F.get_json_object(col(payload), "$.responseData.translatedText"))
