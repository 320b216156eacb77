"""Filter interaction audit by contingency tensor contractions.

Five filters give every document five bits (1: it fails). The documents of a part (a language) are counted by their bits: 32 cells,
a tensor of 2 x 2 x 2 x 2 x 2 with one axis for each filter, and two more such tensors for the documents that a label calls good
or toxic. Whatever an order of the filters does is a contraction of these tensors: at every step each axis is met with a
vector that takes what passes (1, 0), what fails (0, 1) or all (1, 1), and one ``einsum`` does so for all steps of
all orders. The documents are read once; only the cells reach the contraction, at most 32 rows a part.

Filters: A under 100 words; B fewer than 80 distinct words in 100; C more than 10 characters A-Z in 100 code points; D holds one of
``#$%&*|``; E has the text of a document with a smaller id.

Rows: a null text is empty, a null language is the part with the empty name. A text without words passes B. A null id is neither
smaller nor larger than another, so it never fails E and makes none fail. Rows that repeat an id with its text pass E alike. Labels
count as 1 if any row of the id says 1; null ids have none. Every part has all 600 rows, with zeros; an empty table has no part. Input
columns other than the id, the text and the language are left out, so no name can clash.
"""

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopgrain.operators.lookup import lookup
from shopgrain.sources.scratch import materialise

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
SHAPE = (2,) * len(FILTERS)
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

LEAST_WORDS = 100
LEAST_DISTINCT = 80  # in a hundred words
MOST_CAPITALS = 10  # in a hundred code points
BLANKS = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"

PARTS_AT_ONCE = 64
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} bigint" for m in MEASURES)


def with_bits(docs: DataFrame, id_column: str, text_column: str, part_column: str) -> DataFrame:
    """id, part, digest and the bits of A to D (bit 0 is A) of every document, written once without its text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    read = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(part_column), F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, BLANKS), "").alias("words"),
    )
    words = F.size("words").cast("bigint")
    fails = [
        words < LEAST_WORDS,
        100 * F.size(F.array_distinct("words")).cast("bigint") < LEAST_DISTINCT * words,
        100 * F.regexp_count("text", F.lit("[A-Z]")).cast("bigint")
        > MOST_CAPITALS * F.length("text").cast("bigint"),
        F.col("text").rlike(MARKS),
    ]
    bits = sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0))
    return materialise(
        read.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("bits")),
        "filter-bits",
    )


def cells(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, part_column: str
) -> DataFrame:
    """part, bits (0 to 31), n, good, toxic: documents of each part by the filters that they fail."""
    read = with_bits(docs, id_column, text_column, part_column)
    firsts = (
        read.where("id is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        .where("first_id < last_id")
        .select("digest", "first_id")
    )
    copies = lookup(read, firsts, ["digest"]).select(
        "id",
        "part",
        (F.col("bits") + F.coalesce(F.col("id") > F.col("first_id"), F.lit(False)).cast("int") * 16).alias("bits"),
    )
    flags = (
        labels.where(F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("id"))
        .agg(*(F.max((F.col(c) == 1).cast("int")).alias(n) for c, n in (("quality", "good"), ("toxic", "bad"))))
        .where("good = 1 or bad = 1")
    )
    return (
        lookup(copies, flags, ["id"])
        .groupBy("part", "bits")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("toxic"),
        )
    )


def orders() -> list[tuple[int, ...]]:
    """All orders of the five axes."""
    return list(permutations(range(len(FILTERS))))


def selectors() -> dict[str, np.ndarray]:
    """For every step of every order, five vectors of two (step, axis, bit): what each measure takes along each axis."""
    taken = {"kept": [], "removed": [], "failing": [], "unique": []}
    for order in orders():
        for k, own in enumerate(order):
            before, rest = set(order[:k]), set(order[k + 1 :])
            axes = range(len(FILTERS))
            taken["kept"].append([ALL if a in rest else PASS for a in axes])
            taken["removed"].append([FAIL if a == own else PASS if a in before else ALL for a in axes])
            taken["failing"].append([FAIL if a == own else ALL for a in axes])
            taken["unique"].append([FAIL if a == own else PASS for a in axes])
    return {name: np.array(rows, np.int64) for name, rows in taken.items()}


def contract(tensors: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """(part, step): the cells of every part's tensor that a step's vectors take, added up."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *np.moveaxis(taken, 1, 0))


def audit_parts(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Every measure as (part, step of an order); the arguments are (part, cell) counts."""
    # cell bits count from A at bit 0, axes run from A on: the last axis of a reshape is bit 0
    count, fine, bad = (
        np.transpose(x.reshape(-1, *SHAPE), (0, 5, 4, 3, 2, 1)).astype(np.int64) for x in (n, good, toxic)
    )
    taken = selectors()
    removed = contract(count, taken["removed"])
    own = np.array([a for order in orders() for a in order])
    by_filter = np.stack([removed[:, own == a].sum(axis=1) for a in range(len(FILTERS))], axis=1)
    return {
        "kept": contract(count, taken["kept"]),
        "removed": removed,
        "redundant": contract(count, taken["failing"]) - removed,
        "unique_fails": contract(count, taken["unique"]),
        "good_lost": contract(fine, taken["removed"]),
        "toxic_lost": contract(bad, taken["removed"]),
        "shapley": by_filter[:, own],
    }


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = len(FILTERS)
    names = np.repeat(["".join(FILTERS[a] for a in o) for o in orders()], steps)
    at = np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders()))
    for batch in batches:
        for start in range(0, batch.num_rows, PARTS_AT_ONCE):
            rows = batch.slice(start, PARTS_AT_ONCE).to_pylist()
            tensors = np.zeros((3, len(rows), CELLS), np.int64)
            for p, row in enumerate(rows):
                for cell in row["cells"]:
                    tensors[:, p, cell["bits"]] = cell["n"], cell["good"], cell["toxic"]
            found = audit_parts(*tensors)
            columns = [
                pa.array(np.repeat([r["part"] for r in rows], len(at)), pa.string()),
                pa.array(np.tile(names, len(rows)), pa.string()),
                pa.array(np.tile(at, len(rows))),
                *(pa.array(found[m].ravel()) for m in MEASURES),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *MEASURES])


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
) -> DataFrame:
    """What each filter removes at each step of each of the 120 orders, per part: see ``SCHEMA``.

    ``labels`` holds the id, ``quality`` and ``toxic``. Counts are of documents: kept after the step, removed at it, redundant (fail
    its filter, gone before), unique_fails (fail its filter alone), good and toxic ones removed, and shapley (what its filter
    removes, added over all orders).
    """
    counted = cells(docs, labels, id_column, text_column, part_column)
    gathered = counted.groupBy("part").agg(
        F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells")  # 32 at most
    )
    return gathered.mapInArrow(_audited, SCHEMA)
