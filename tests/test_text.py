import re

import pytest

from pyspark.sql import functions as F
from shopgrain import fixed_values as V
from shopgrain.functions import text
from tests.helpers import apply, random_strings

SAMPLE = ["", " ", " \t", "  a b　", "\x1cx\x1f", "\x85é "] + random_strings(400)


@pytest.mark.parametrize(
    "ours, expected",
    [
        (text.strip_ws, str.strip),
        (text.blank_to_null, lambda s: s.strip() or None),
        (text.or_missing, lambda s: s or "N/A"),
        (text.one_line, lambda s: s.replace("\n", " ").strip()),
    ],
)
def test_text_rules_hold_for_any_text(spark, ours, expected):
    assert apply(spark, SAMPLE, ours) == [expected(s) for s in SAMPLE]


@pytest.mark.parametrize(
    "ours, shape, stable",
    [
        (text.slug, r"[a-z0-9_]*", True),
        (text.table_name, r"(t_[0-9][a-z0-9_]*|[a-z][a-z0-9_]*)", True),
        (text.sheet_base_name, r"[^:\\/?*\[\]]{1,31}", False),
    ],
)
def test_names_have_their_shape_for_any_text(spark, ours, shape, stable):
    names = apply(spark, SAMPLE, ours)
    assert all(re.fullmatch(f"(?s){shape}", n) for n in names)
    assert max(map(len, names)) <= 63
    if stable:  # a name is its own name
        assert apply(spark, names, ours) == names


@pytest.mark.parametrize(
    "ours, cases",
    [
        (text.slug, {"  Two  Words ": "two_words", "a-b.c": "abc", "_x_": "_x_", "A\u00a0B": "a_b", "": ""}),
        (text.table_name, {"__a--b__": "a_b", "Ünï": "n", "7": "t_7", "": "tabela", "é": "tabela"}),
        (text.sheet_base_name, {" a  b ": "a b", "x" * 40: "x" * 31, "[]": "Categoria", "": "Categoria",
                                "a\t\nb": "a b", "a//b": "a b"}),
    ],
)
def test_names_of_given_texts(spark, ours, cases):
    assert apply(spark, list(cases), ours) == list(cases.values())


def test_null_texts(spark):
    for ours, expected in [
        (text.strip_ws, None),
        (text.slug, None),
        (text.table_name, "tabela"),
        (text.sheet_base_name, "Categoria"),
        (text.or_missing, "N/A"),
    ]:
        assert apply(spark, [None], ours) == [expected]


def test_accents_are_deleted_from_slugs_and_folded_nowhere(spark):
    assert apply(spark, ["Ficção Científica", "Add a  comment"], text.slug) == [
        "fico_cientfica",
        "add_a_comment",
    ]


def test_table_names(spark):
    names = ["9 Lives!", "--", "a" * 80, "Sci-Fi / Fantasy"]
    assert apply(spark, names, text.table_name) == ["t_9_lives", "tabela", "a" * 63, "sci_fi_fantasy"]
    assert apply(spark, ["Todos"], lambda x: text.qualified_table_name(x, "ns", "p_")) == [
        "ns.p_todos"
    ]


def test_illegal_sheet_characters_become_one_space(spark):
    assert apply(spark, ["a:b/[c]*d\\e?f"], text.sheet_base_name) == ["a b c d e f"]


def test_labels(spark):
    row = spark.sql(
        "SELECT CAST(3.5 AS DECIMAL(18,2)) p, CAST(NULL AS DECIMAL(18,2)) q, 7L s, true t, "
        "CAST(NULL AS BOOLEAN) u, TIMESTAMP '2024-02-01 03:04:05' ts"
    ).select(
        text.price_label("p"),
        text.price_label("q"),
        text.price_label("p", "£"),
        text.number_label("s"),
        text.flag_label("t"),
        text.flag_label("u"),
        text.run_stamp("ts"),
        text.rate_line(F.lit("6.5").cast("decimal(18,6)")),
        text.rate_line(F.lit(None).cast("decimal(18,6)")),
    ).first()
    assert list(row) == [
        "R$ 3.50", "N/A", "£ 3.50", "7", "SIM", "NAO", "20240201_030405",
        "Taxa GBP->BRL carregada: 6.5000", V.NO_RATE_LINE,
    ]


def test_capture_line_shows_the_limit_or_the_ordinal(spark):
    item = spark.sql(
        "SELECT 3L ord, 'T' title, 10.5BD price, 2 rating, 'Two' rating_word, "
        "'In stock\\n(4 available)' availability, 4L stock, true low_stock, '' category"
    )
    whole, limited = item.select(text.capture_line("ord"), text.capture_line("ord", 100)).first()
    rest = (
        "titulo=T | preco=R$ 10.50 | avaliacao=2 (Two) | disponibilidade=In stock (4 available) | "
        "estoque=4 | estoque_baixo=SIM | categoria=N/A"
    )
    assert whole == f"[003/003] {rest}"
    assert limited == f"[003/100] {rest}"
