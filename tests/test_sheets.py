import pytest

from pyspark.sql import functions as F

from shopgrain.operators.ordinal import with_place
from shopgrain.operators.sheets import placeholder_if_empty, sheet_names
from tests.helpers import random_strings, strings_frame


def named(spark, values):
    return {r.x: r.sheet for r in sheet_names(strings_frame(spark, values), "x").collect()}


LONG = "A category name that is much too long "


@pytest.mark.parametrize(
    "names",
    [
        {" Art": "Art", "Art": "Art_2", "Art ": "Art_3", "art": "art"},
        {"Todos": "Todos_2", "Painel": "Painel_2", "Todos/": "Todos_3", "Painel?": "Painel_3", "x": "x"},
        {"[a b]": "a b", "a b": "a b_2", "a/b": "a b_3", "a:b": "a b_4", "*": "Categoria", "?": "Categoria_2"},
        {LONG + "1": "A category name that is much too"[:31], LONG + "2": "A category name that is much_2",
         LONG + "3": "A category name that is much_3"},
        # A made name steps over a name that a category has by nature.
        {"Todos": "Todos_3", "Todos_2": "Todos_2", "Todos?": "Todos_4"},
        {"Todos": "Todos_2", "Todos_02": "Todos_02", "Todos_1": "Todos_1"},
    ],
)
def test_names(spark, names):
    assert named(spark, [*names, None, "", "  "]) == names


def check(names, values):
    """What holds for any names: all categories, no name twice or reserved, at most 31 characters."""
    assert set(names) == {v for v in values if v is not None and v.strip()}
    assert len(set(names.values())) == len(names)
    assert not {"Todos", "Painel"} & set(names.values())
    assert all(0 < len(n) <= 31 for n in names.values())


def test_hundreds_of_one_stem_and_natural_names_among_them(spark):
    values = [LONG + f"{i:04}" for i in range(1200)]
    natural = ["A category name that is much_7", "A category name that is muc_100"]
    names = named(spark, values + natural)
    check(names, values + natural)
    assert all(names[n] == n for n in natural)
    assert names[LONG + "0001"] == "A category name that is much_2"
    assert names[LONG + "0006"] == "A category name that is much_8"
    assert names[LONG + "0098"] == "A category name that is muc_101"
    assert names[LONG + "1199"] == "A category name that is mu_1202"
    ordered = [names[v] for v in values]
    numbers = [int(n.rsplit("_", 1)[1]) for n in ordered[1:]]
    assert numbers == sorted(numbers)


def test_many_categories_of_one_stem_are_spread(spark):
    """200,000 categories of one stem; every step of the numbering is dealt over all tasks."""
    n = 200_000
    rows = spark.range(n).select(F.concat(F.lit(LONG), F.format_string("%06d", "id")).alias("x"))
    names = sheet_names(rows, "x").cache()
    assert names.select("sheet").distinct().count() == names.count() == n
    last = names.where(F.col("x") == LONG + "199999").first().sheet
    assert last == "A category name that is m_200001"[:31] or last.endswith("_200000") or last.endswith("_200001")
    placed = with_place(rows.withColumn("g", F.lit("one")), "g", ["x"], "at", partitions=8)
    parts = placed.groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in parts)
    assert sizes[-1] < 2.5 * sizes[len(sizes) // 2]


def test_places_within_groups(spark):
    rows = strings_frame(spark, [f"{i % 7}-{i * 37 % 100:03}" for i in range(100)] * 2)
    groups = rows.withColumn("g", F.substring("x", 1, 1))
    got = {}
    for r in with_place(groups, "g", ["x"], "at").collect():
        got.setdefault(r.g, []).append((r.at, r.x))
    for values in got.values():
        assert [at for at, _ in sorted(values)] == list(range(1, len(values) + 1))
        assert [x for _, x in sorted(values)] == sorted(x for _, x in values)


def test_stems_that_become_equal_when_they_get_shorter(spark):
    stems = ["B" * 27 + "x", "B" * 27 + "y"]
    values = [stem + f"zzz{i:04}" for stem in stems for i in range(150)]
    check(named(spark, values), values)


def test_any_names(spark):
    values = random_strings(300, seed=5, longest=45) + ["Todos", "Painel", "Todos_2"]
    check(named(spark, values), values)


def test_placeholder(spark):
    df = strings_frame(spark, ["a", "b"])
    assert placeholder_if_empty(df).count() == 0
    rows = placeholder_if_empty(df.where("i > 5")).collect()
    assert [tuple(r) for r in rows] == [("Nenhum dado extraído. Verifique seletores.",)]
