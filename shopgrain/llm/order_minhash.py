"""Document fingerprints by order MinHash.

A text's elements are its k-mers of code points, each numbered by its occurrence, so that repeats count. One
hash deals the elements to slots and orders them within a slot; the ``picks`` smallest of a slot, put back
into text order, are hashed together into the slot's value. Two texts agree on a slot if they share its smallest
elements in the same order, which falls with their edit distance. A slot that got fewer elements than
that (in a short text) orders all elements by a hash of its own.

A fingerprint is a string of four hex digits per slot; likeness is the share of equal slots.

Rows: null text is empty text, whose fingerprint is all zeros. A text below k code points is one element.
Repeated rows each come out; equal texts have equal fingerprints. Input columns other than the id and the text are
left out, so no name can clash.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.llm.batches import text_slices, texts_of

BASE = 0x9E3779B97F4A7C15
SPREAD = 4  # ranges per shuffle partition, to even them out
_WORD = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Sketcher:
    """k code points per k-mer, ``picks`` k-mers per tuple, ``slots`` (a power of two) tuples."""

    k: int = 8
    picks: int = 2
    slots: int = 64

    def _kmers(self, text: str) -> np.ndarray:
        """Hash of each k-mer in text order."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(points) < self.k:
            points = np.pad(points, (0, self.k - len(points)))
        h, width = points.astype(np.uint64) + np.uint64(1), 1
        whole, done = None, 0  # binary powers of the width make up k
        rest = self.k
        while rest:
            if rest & 1:
                if whole is None:
                    whole, done = h, width
                else:
                    n = len(whole) - width
                    power = np.uint64(pow(BASE, width, 1 << 64))
                    whole, done = whole[:n] * power + h[done : done + n], done + width
            rest >>= 1
            if rest:
                power = np.uint64(pow(BASE, width, 1 << 64))
                h, width = h[: len(h) - width] * power + h[width:], 2 * width
        return _mix(whole[: len(points) - self.k + 1])

    def values(self, text: str) -> np.ndarray:
        """The slots' values, 16 bits each."""
        if not text:
            return np.zeros(self.slots, np.uint16)
        kmer = self._kmers(text)
        n = len(kmer)
        bits = np.uint64(max(1, n.bit_length()))
        places = np.uint64((1 << int(bits)) - 1)
        place = np.arange(n, dtype=np.uint64)
        order = np.sort((kmer & ~places) | place)
        at = (order & places).astype(np.int64)
        kind = order >> bits
        index = np.arange(n)
        first = np.ones(n, bool)
        first[1:] = kind[1:] != kind[:-1]
        occurrence = (index - np.maximum.accumulate(np.where(first, index, 0))).astype(np.uint64)
        element = np.empty(n, np.uint64)
        element[at] = _mix(kmer[at] + occurrence * np.uint64(BASE))

        ranked = np.sort((element & ~places) | place)
        slot_of = ranked >> np.uint64(64 - (self.slots - 1).bit_length())
        begin = np.searchsorted(slot_of, np.arange(self.slots + 1, dtype=np.uint64))
        picks = min(self.picks, n)
        full = np.diff(begin) >= picks
        chosen = np.zeros((self.slots, picks), np.int64)
        rows = begin[:-1][full][:, None] + np.arange(picks)
        chosen[full] = (ranked[rows] & places).astype(np.int64)
        short = np.flatnonzero(~full)
        for begin_at in range(0, len(short), 8):
            some = short[begin_at : begin_at + 8]
            own = _mix(element[None, :] ^ _mix(some.astype(np.uint64) + np.uint64(1))[:, None])
            if n > picks:
                chosen[some] = np.argpartition(own, picks - 1, axis=1)[:, :picks]
            else:
                chosen[some] = np.arange(n)
        chosen.sort(axis=1)
        value = np.arange(1, self.slots + 1, dtype=np.uint64)
        for j in range(picks):
            value = _mix(value * np.uint64(BASE) + kmer[chosen[:, j]])
        return (value >> np.uint64(48)).astype(np.uint16)

    def fingerprint(self, text: str) -> str:
        return as_text(self.values(text))


def as_text(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def likeness(one: Column, other: Column, slots: int) -> Column:
    """Share of equal slots of two fingerprints."""
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(slots - 1)),
        F.lit(0),
        lambda total, i: total
        + (F.substr(one, i * 4 + 1, F.lit(4)) == F.substr(other, i * 4 + 1, F.lit(4))).cast("int"),
    )
    return same / F.lit(float(slots))


def fingerprints(
    docs: DataFrame,
    sketcher: Sketcher = Sketcher(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """id, fingerprint of every document."""
    kind = docs.schema[id_column].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            found = [sketcher.fingerprint(t) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.string())], ["id", "fingerprint"]
            )

    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    done = read.mapInArrow(sketch, f"id {kind}, fingerprint string")
    return done.withColumnRenamed("id", id_column)


def _in_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """id, text with the number of their range of ids; null ids are below all others."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = partitions * SPREAD
    shares = [i / ranges for i in range(1, ranges)]
    keys = docs.select(F.col("id").cast("double").alias("key"))
    bounds = sorted(set(keys.approxQuantile("key", shares, 0.2 / ranges)))
    splits = [-float("inf"), *(bounds or [0.0]), float("inf")]
    keyed = docs.withColumn("key", F.coalesce(F.col("id").cast("double"), F.lit(-float("inf"))))
    cut = Bucketizer(splits=splits, inputCol="key", outputCol="range")
    ranged = cut.transform(keyed)
    below = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(F.col("range").cast("int"))
    return ranged.select("id", "text", below.alias("range")), partitions


def edited_fingerprints(
    docs: DataFrame,
    sketcher: Sketcher = Sketcher(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Fingerprints of texts and of their edited texts.

    The last third of a text is replaced by the first as many code points of the next document in descending
    order of a numeric id (after the last: the first; null ids come last; equal ids in order of their texts). Returns
    id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are shuffled once, by ranges of the id; the largest document of a range also goes to the range
    above, whose smallest document it follows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    read = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    ranged, partitions = _in_ranges(read)
    # one row per range, as many as the settings say
    tops = ranged.groupBy("range").agg(F.max("id").alias("top")).collect()
    tops.sort(key=lambda row: row["range"])
    above = {row["range"]: tops[(i + 1) % len(tops)]["range"] for i, row in enumerate(tops)}
    spark = docs.sparkSession
    guests_of = spark.createDataFrame(
        [(row["range"], row["top"], above[row["range"]]) for row in tops],
        f"range int, top {kind}, above int",
    )
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("above").alias("range"), F.lit(True).alias("guest"))
    placed = (
        ranged.join(F.broadcast(guests_of), "range")
        .select(
            "id",
            "text",
            F.explode(
                F.when(F.col("id").eqNullSafe(F.col("top")), F.array(own, guest)).otherwise(
                    F.array(own)
                )
            ).alias("to"),
        )
        .select("id", "text", "to.range", "to.guest")
        .repartition(partitions, "range")
        .sortWithinPartitions("range", "guest", F.desc_nulls_last("id"), "text")
    )
    columns = (
        f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [c.split()[0] for c in columns.split(", ")]

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document before, until its next one is known
        for batch in text_slices(batches, "text"):
            out: list[tuple] = []
            ids = batch.column("id")
            ranges = batch.column("range").to_pylist()
            guests = batch.column("guest").to_pylist()
            for i, text in enumerate(texts_of(batch, "text")):
                if guests[i] and (held is None or held[0] != ranges[i]):
                    continue  # the next document is known already
                values = sketcher.values(text)
                if held is not None and held[0] == ranges[i]:
                    out.append(_edited(sketcher, held, text, values))
                held = None if guests[i] else (ranges[i], ids[i].as_py(), text, values)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(column, ids.type if name == "id" else None)
                        for name, column in zip(names, zip(*out))
                    ],
                    names,
                )

    return placed.mapInArrow(edit, columns).withColumnRenamed("id", id_column)


def _edited(sketcher: Sketcher, held: tuple, next_text: str, next_values: np.ndarray) -> tuple:
    _, doc_id, text, values = held
    cut = len(text) // 3
    edited = text[: len(text) - cut] + next_text[:cut]
    edited_values = sketcher.values(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        as_text(values),
        as_text(edited_values),
        float((values == edited_values).mean()),
        float((values == next_values).mean()),
    )
