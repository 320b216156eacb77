from decimal import Decimal

from pyspark.sql import functions as F
from shopgrain import fixed_values as V
from shopgrain.operators import enrich
from shopgrain.sources.payloads import rates_from_payloads, translations_from_payloads
from tests.helpers import sorted_rows, strings_frame


def labelled(spark, values, labels=None):
    df = enrich.with_label(strings_frame(spark, values), "x", "y", labels)
    return [r.y for r in df.orderBy("i").collect()]


def test_builtin_labels(spark):
    values = ["Travel", " Science\tFiction ", "Womens Fiction", "", "  ", None, "add A comment"]
    assert labelled(spark, values) == [
        "viagem", "ficcao_cientifica", "Womens Fiction", "", "  ", None, "adicionar_comentario",
    ]
    assert len(V.CATEGORY_LABELS) == len(set(V.CATEGORY_LABELS.values())) == 27


def test_a_given_dictionary_replaces_the_builtin_one(spark):
    labels = spark.createDataFrame([("travel", "T")], "key string, label string")
    assert labelled(spark, ["TRAVEL", "Art", None], labels) == ["T", "Art", None]


def translated(spark, values, rows):
    answers = rows and spark.createDataFrame(rows, "key string, translated string")
    df = enrich.with_translation(strings_frame(spark, values), answers, "x", "y")
    return [r.y for r in df.orderBy("i").collect()]


def test_translation(spark):
    rows = [("a", " A! "), ("b", ""), ("c", None), ("c", " "), ("d", "D"), ("d", None)]
    values = ["a", " a ", "b", " c ", "d", "x ", "", "  ", None]
    assert translated(spark, values, rows) == ["A!", "A!", "b", "c", "D", "x", "", "  ", None]
    assert translated(spark, values, None) == values


def test_only_texts_without_an_answer_are_asked_for(spark):
    known = spark.createDataFrame([("a", None)], "key string, translated string")
    df = strings_frame(spark, ["a ", "b c", " b c", "", None])
    assert sorted_rows(enrich.translation_requests(df, known, "x")) == [("b c", "b%20c")]
    assert enrich.translation_requests(df, text="x").count() == 2


def test_rate_precedence(spark):
    rates = spark.createDataFrame([(0.0,), (-2.0,), (None,), (6.5,)], "rate double")
    unusable = rates.where("rate <= 0")

    def rate(*args):
        return spark.range(1).select(enrich.run_rate(*args)).first()[0]

    assert rate(rates) == Decimal("6.5")
    assert rate(rates, 7.25) == Decimal("7.25")
    assert rate(rates, -1) == Decimal("6.5")
    assert rate(unusable) is None
    assert rate(rates.where("false")) is None
    assert rate() is None


def test_price_without_a_rate_keeps_the_source(spark):
    df = spark.sql("SELECT CAST('2.675' AS DECIMAL(18,4)) AS price_src")
    assert enrich.with_price(df, enrich.run_rate()).first().price == Decimal("2.68")
    assert enrich.with_price(df, enrich.run_rate(None, 2)).first().price == Decimal("5.35")


def test_no_item_is_lost_to_the_rate(spark):
    rates = spark.createDataFrame([], "rate double")
    df = spark.range(5).select(F.lit("1").cast("decimal(18,4)").alias("price_src"))
    assert enrich.with_price(df, enrich.run_rate(rates)).count() == 5


def test_payload_tables(spark):
    payloads = spark.createDataFrame(
        [("k", '{"rates": {"BRL": 6.5}, "responseData": {"translatedText": "x"}}'), ("l", "bad")],
        "key string, payload string",
    )
    assert sorted_rows(rates_from_payloads(payloads)) == [(Decimal("6.5"),)]
    assert sorted_rows(translations_from_payloads(payloads)) == [("k", "x"), ("l", None)]
