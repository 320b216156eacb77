from decimal import Decimal

from pyspark.sql import functions as F
from shopgrain.functions import parse
from tests.helpers import apply


def test_price_number(spark):
    cases = {
        "£51.77": "51.7700", " £ 1,5 ": "1.5000", "-3": "-3.0000", "+.5": "0.5000", "7.": "7.0000",
        "1,234.56": None, "n/a": None, "": None, "nan": None, "inf": None, "1_000": None,
        "1.0d": None, "1e3": None, "£": None, None: None, "1" * 30: None,
    }
    got = apply(spark, list(cases), parse.price_number)
    assert got == [None if v is None else Decimal(v) for v in cases.values()]


def test_stock_count(spark):
    cases = {
        "In stock (22 available)": 22, "In stock\n(0  available)": 0, "Out of stock": None,
        "(x available)": None, "( 3 available)": None, "": None, None: None,
        "(99999999999999999999 available)": None, "(3000000000 available)": 3000000000,
    }
    assert apply(spark, list(cases), parse.stock_count) == list(cases.values())


def test_rating_word_is_the_first_rating_token(spark):
    cases = {
        "star-rating Three": "Three", "One Two": "One", "Five\tx": "Five", "three": None,
        "Threes Four": "Four", "x-Two": None, "": None, None: None, "a Two b": "Two",
    }
    assert apply(spark, list(cases), parse.rating_word) == list(cases.values())
    assert apply(spark, ["One", "Five", "Six", "one", None], parse.rating_number) == [
        1, 5, None, None, None,
    ]


def test_low_stock_is_never_null(spark):
    def low(x):
        return parse.low_stock(F.col(x).cast("bigint"))

    assert apply(spark, ["4", "5", "0", "-1", None], low) == [True, False, True, True, False]
    assert apply(spark, ["4"], lambda x: parse.low_stock(F.col(x).cast("bigint"), 3)) == [False]


def test_conversion_rounds_half_up_on_decimals(spark):
    def at(rate):
        return lambda x: parse.converted_price(
            F.col(x).cast("decimal(18,4)"), F.lit(rate).cast("decimal(18,6)")
        )

    assert apply(spark, ["1.005", "2.675", None], at("1")) == [
        Decimal("1.01"), Decimal("2.68"), None,
    ]
    assert apply(spark, ["10.0049"], at(None)) == [Decimal("10.00")]
    assert apply(spark, ["10"], at("0")) == [Decimal("10.00")]
    # The largest product keeps all its digits.
    assert apply(spark, ["99999999999999"], at("999999999999")) == [
        Decimal("99999999999899000000000001.00")
    ]


def test_json_payloads(spark):
    rates = {
        '{"rates": {"BRL": 6.5}}': Decimal("6.500000"), '{"rates": {"BRL": 0}}': None,
        '{"rates": {"BRL": -1}}': None, '{"rates": {}}': None, "{}": None, "oops": None, None: None,
        '{"rates": {"BRL": "x"}}': None,
    }
    assert apply(spark, list(rates), parse.rate_from_json) == list(rates.values())
    answers = {
        '{"responseData": {"translatedText": " olá "}}': "olá", '{"responseData": null}': None,
        '{"responseData": {"translatedText": "  "}}': None, "{}": None, "<html>": None, None: None,
    }
    assert apply(spark, list(answers), parse.translation_from_json) == list(answers.values())
