"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct shingles (A-Z lower-cased, words between white space). Each shingle hash falls
into one of ``REGISTERS`` buckets; a bucket keeps of its smallest hash the number of leading zeros (6 bits) and
the next ``MANTISSA`` bits. An empty bucket of a small set takes the register of another bucket by a fixed random order, so
that registers of two sets agree with about the probability of their Jaccard similarity. Four registers make a
band; sets that share a band are candidates. With 32 bands a pair at 0.75 is missed with probability 5e-6.

Candidates pass an estimate from their registers, corrected for chance collisions and with a margin of
``SIGMAS`` standard errors, and then a count on the full sets, which alone decides.

Sets are first reduced to distinct ones. In a band's group every set is held against one pivot, which links the usual
group of copies with a pair per member; then against another pivot, for sets that are not yet in the pivot's component.
What is still in several components is compared exactly within tasks, in blocks of bounded size; only links that
connect components leave a task. So no group is ever expanded into all pairs and no pair that shares a band
goes unexamined unless it is connected already.

Rows: texts without words (null, empty) have no set, 0 shingles and are linked with nothing. Repeated rows each come
out. A null id takes part, and its component is the smallest id of its group, null if there is none. Input columns other
than the id and the text are left out, so no name can clash.
"""

import hashlib
from collections.abc import Iterator
from functools import cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.llm.batches import bounded, given_back, groups, text_slices, texts_of
from shopgrain.llm.components import sized_components
from shopgrain.operators.lookup import by_merge, by_size, lookup, salted_join
from shopgrain.sources.scratch import Size, materialise, measured

REGISTERS, BAND, MANTISSA = 128, 4, 10
BANDS = REGISTERS // BAND
WORDS = 5
PERCENT = 75
SIGMAS = 6
PIVOT_ROUNDS = 3
BLOCK = 512
CACHED_WORDS = 150_000  # a speed setting
_REST = 64 - (REGISTERS - 1).bit_length()  # bits of a hash below the bucket number


class WordHashes(dict):
    """64-bit hash by word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


_HASHES = WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; one for a shorter text, none without words."""
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.array([_HASHES[w] for w in found], np.uint64)
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    total = np.full(n, width, np.uint64)
    for j in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    total = np.sort(_mix(total))
    keep = np.ones(n, bool)
    keep[1:] = total[1:] != total[:-1]
    return total[keep]


@cache
def _borrow_order() -> np.ndarray:
    """For each bucket, the order in which it asks the others."""
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.permuted(np.tile(np.arange(REGISTERS), (REGISTERS, 1)), axis=1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set, 16 bits each."""
    begin = np.searchsorted(hashes >> np.uint64(_REST), np.arange(REGISTERS + 1, dtype=np.uint64))
    filled = np.flatnonzero(begin[1:] > begin[:-1])
    low = hashes[begin[filled]] & np.uint64((1 << _REST) - 1)
    length = np.frexp((low >> np.uint64(_REST - 53)).astype(np.float64))[1] + (_REST - 53)
    zeros = np.minimum(_REST - length, 52).astype(np.uint64)
    mantissa = (low << (np.uint64(64 - _REST + 1) + zeros)) >> np.uint64(64 - MANTISSA)
    out = np.empty(REGISTERS, np.uint16)
    out[filled] = (zeros << np.uint64(MANTISSA)) | mantissa
    if len(filled) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), filled, assume_unique=True)
        out[empty] = out[filled[_borrow_order()[empty][:, filled].argmin(axis=1)]]
    return out


@cache
def _chance(one: int, other: int) -> float:
    """Probability that registers of unrelated sets agree; sizes as steps of a tenth of their log."""
    zeros = np.arange(53)[:, None]
    cell = np.arange(1 << MANTISSA)[None, :]
    low = ((1 << MANTISSA) + cell) * 2.0 ** -(MANTISSA + 1 + zeros)
    high = low + 2.0 ** -(MANTISSA + 1 + zeros)
    share = []
    for step in (one, other):
        load = max(1.0, np.exp(step / 10) / REGISTERS)
        share.append((1 - low) ** load - (1 - high) ** load)
    return float((share[0] * share[1]).sum())


def estimate(equal: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers and the set sizes, less chance collisions."""
    steps = [np.round(np.log(np.maximum(n, 1)) * 10).astype(int) for n in (one, other)]
    chance = np.array([_chance(a, b) for a, b in zip(*steps)])
    return (equal / REGISTERS - chance) / (1 - chance)


def _may_link(equal: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether a pair at the wanted similarity could have so few equal registers; sizes must allow it too."""
    wanted = PERCENT / 100
    small, large = np.minimum(one, other), np.maximum(one, other)
    error = np.sqrt(wanted * (1 - wanted) / np.minimum(REGISTERS, small))
    fits = 100 * small >= PERCENT * large
    fits[fits] = estimate(equal[fits], one[fits], other[fits]) >= wanted - SIGMAS * error[fits]
    return fits


def _digest(text_column: str) -> Column:
    """Tells texts of one id, or without one, apart; null for a null text."""
    return F.unhex(F.sha2(F.col(text_column), 256))


def signatures(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id, digest (of the text), n_shingles, set_key (null without a set), registers (bands as longs)."""
    kind = docs.schema[id_column].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with given_back(_HASHES.clear):
            for batch in text_slices(batches, "text"):
                sizes, keys, signs = [], [], []
                for text in texts_of(batch, "text"):
                    hashes = shingle_set(text)
                    sizes.append(len(hashes))
                    found = len(hashes) > 0
                    keys.append(_set_key(hashes) if found else None)
                    signs.append(registers(hashes).view(np.int64) if found else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("digest"),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(signs, pa.list_(pa.int64())),
                    ],
                    ["id", "digest", "n_shingles", "set_key", "registers"],
                )

    read = bounded(docs).select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        _digest(text_column).alias("digest"),
    )
    schema = f"id {kind}, digest binary, n_shingles bigint, set_key binary, registers array<bigint>"
    return read.mapInArrow(sign, schema)


def _set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _row(id_column: Column | str) -> Column:
    """Tells ids apart next to a digest: equal ids have equal numbers, null ids too."""
    return F.xxhash64(id_column)


def _full_sets(
    docs: DataFrame, wanted: DataFrame, repeats: bool, id_column: str, text_column: str
) -> DataFrame:
    """node, hashes of the wanted nodes (node, first, set_key), from the rows that bear them first.

    A row is found by its text's digest together with its id, so neither null ids nor an id with many texts make a large
    group. ``repeats`` tells whether some row comes more than once.
    """
    texts = docs.select(
        _digest(text_column).alias("digest"),
        _row(F.col(id_column)).alias("row"),
        F.col(text_column).alias("text"),
    )
    firsts = wanted.select(
        F.col("first.digest").alias("digest"), _row("first.id").alias("row"), "node", "set_key"
    )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with given_back(_HASHES.clear):
            for batch in text_slices(batches, "text"):
                sets = [shingle_set(text).view(np.int64) for text in texts_of(batch, "text")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"]
                )

    read = lookup(texts, firsts, ["digest", "row"], "inner").select("node", "text")
    found = read.mapInArrow(hashes, "node bigint, hashes array<bigint>")
    return found.dropDuplicates(["node"]) if repeats else found


def _both(pairs: DataFrame, known: DataFrame, size: Size) -> DataFrame:
    """Written pairs (a, b) with the columns of ``known`` (node, ...) for either side, as ``<column>_a`` and ``<column>_b``.

    ``size`` is that of ``known``. A pivot is the a of as many pairs as its groups have members: they are spread.
    """
    sides = {
        side: known.select(
            F.col("node").alias(side),
            *(F.col(c).alias(f"{c}_{side}") for c in known.columns if c != "node"),
        )
        for side in "ab"
    }
    return salted_join(pairs, sides["a"], ["a"], "inner").join(by_size(sides["b"], size), "b")


def _estimated(pairs: DataFrame, signs: DataFrame, size: Size) -> DataFrame:
    """Pairs (a, b) that pass the estimate."""
    pairs = _both(materialise(pairs, "offered-pairs"), signs, size)

    def pass_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                signs_of = [
                    batch.column(c).flatten().to_numpy().view(np.uint16).reshape(-1, REGISTERS)
                    for c in ("registers_a", "registers_b")
                ]
                sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
                keep = _may_link((signs_of[0] == signs_of[1]).sum(axis=1), *sizes)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(pass_on, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, size: Size) -> DataFrame:
    """Written pairs whose full sets reach the similarity."""
    shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
    union = F.size("hashes_a") + F.size("hashes_b") - shared
    return _both(pairs, sets, size).where(100 * shared >= PERCENT * union).select("a", "b")


def _links_in_blocks(mixed: DataFrame) -> DataFrame:
    """Links (a, b) that join different components, among the sets that share a band group.

    ``mixed`` has band, key, members, node, component, n, registers, hashes. Members are dealt to blocks; every pair of
    a group's blocks is one task's work. A pair that passes the estimate is counted on the full sets at once, unless links
    found in the task connect it already.
    """
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = (
        mixed.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(others))
        .withColumn("one", F.least("block", "other"))
        .withColumn("two", F.greatest("block", "other"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in groups(batches, ["band", "key", "one", "two"]):
            found += _links_of_group(group)
            if len(found) > 1000:
                yield _pair_batch(found)
                found = []
        yield _pair_batch(found)

    dealt = placed.select(
        "band", "key", "one", "two", "block", "node", "component", "n", "registers", "hashes"
    )
    partitions = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["band", "key", "one", "two"]
    together = dealt.repartition(partitions, *by).sortWithinPartitions(*by, "n")
    return together.mapInArrow(compare, "a bigint, b bigint")


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], ["a", "b"])


def _links_of_group(group: pa.RecordBatch) -> list[tuple[int, int]]:
    """Links between components for the pairs that are this group's work, in order of n."""
    band = group.column("band")[0].as_py()
    across = group.column("one")[0] != group.column("two")[0]
    node, part, n, block = (group.column(c).to_numpy() for c in ("node", "component", "n", "block"))
    labels, member, counts = np.unique(part, return_inverse=True, return_counts=True)
    if len(labels) < 2:
        return []
    bands = group.column("registers").flatten().to_numpy().reshape(len(node), -1)
    signs, sets = bands.view(np.uint16), group.column("hashes")
    main = member == counts.argmax()
    outside = np.flatnonzero(~main)
    # sizes must allow the similarity
    low = np.searchsorted(n, np.ceil(n[outside] * PERCENT / 100))
    high = np.searchsorted(n, n[outside] * 100 // PERCENT, side="right")
    place = np.arange(len(node))
    joined = list(range(len(labels)))

    def root(x: int) -> int:
        while joined[x] != x:
            joined[x] = joined[joined[x]]
            x = joined[x]
        return x

    found = []
    for i, begin, end in zip(outside, low, high):
        near = slice(begin, end)
        # outsiders meet each other once, and a pair is the work of its first band
        wanted = (main[near] | (place[near] > i)) & (member[near] != member[i])
        if across:
            wanted &= block[near] != block[i]
        some = begin + np.flatnonzero(wanted)
        if band and len(some):
            some = some[~(bands[some, :band] == bands[i, :band]).any(axis=1)]
        if not len(some):
            continue
        equal = (signs[some] == signs[i]).sum(axis=1)
        passed = _may_link(equal, np.full(len(some), n[i]), n[some])
        own = None
        for x in some[passed][np.argsort(-equal[passed], kind="stable")]:
            a, b = root(member[i]), root(member[x])
            if a == b:
                continue
            own = sets[int(i)].values.to_numpy() if own is None else own
            shared = _shared(own, sets[int(x)].values.to_numpy())
            if 100 * shared >= PERCENT * (n[i] + n[x] - shared):
                joined[a] = b
                found.append((int(node[i]), int(node[x])))
    return found


def _shared(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sets sorted as unsigned numbers."""
    one, other = one.view(np.uint64), other.view(np.uint64)
    at = np.searchsorted(one, other)
    at[at == len(one)] = 0
    return int(np.count_nonzero(one[at] == other))


def _links(
    docs: DataFrame, nodes: DataFrame, repeats: bool, id_column: str, text_column: str
) -> tuple[DataFrame, Size] | None:
    """node, component of the linked sets; None if nothing is linked. ``nodes``: node, first, set_key, n, registers.

    A join has a side of a counted size or is a merge join: ``bands`` has ``BANDS`` rows for each that Spark sees in the files.
    """
    bands = nodes.select("node", F.posexplode("registers").alias("band", "key"))
    shared_bands = (
        bands.groupBy("band", "key")
        .agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("pivot"))
        .where("members > 1")
    )
    shared = materialise(bands.join(by_merge(shared_bands), ["band", "key"]), "bands")
    wanted = by_size(*measured(shared.select("node").distinct(), "wanted"))
    signs, signs_size = measured(nodes.join(wanted, "node"), "candidates")
    if not signs_size.rows:
        return None
    sets, sets_size = measured(_full_sets(docs, signs, repeats, id_column, text_column), "sets")
    signs = signs.select("node", "n", "registers")

    pairs = shared.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    tested, tested_size = measured(_estimated(pairs.where("a <> b").distinct(), signs, signs_size), "pairs")
    links = materialise(_verified(tested, sets, sets_size), "links")
    for turn in range(1, PIVOT_ROUNDS + 1):
        labels, labels_size = sized_components(links)
        parts = shared.join(by_size(labels, labels_size), "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        # another pivot in every band, so that a group of copies is held against many
        order = F.xxhash64("node", "band", F.lit(turn))
        mixed = (
            parts.groupBy("band", "key")
            .agg(
                F.min("component").alias("lowest"),
                F.max("component").alias("highest"),
                F.min_by("node", order).alias("chosen"),
                F.min_by("component", order).alias("part"),
            )
            .where("lowest <> highest")
            .drop("lowest", "highest")
        )
        open_groups = materialise(parts.drop("pivot").join(mixed, ["band", "key"]), "mixed")
        if open_groups.isEmpty():
            return labels, labels_size
        if turn == PIVOT_ROUNDS:
            rest = open_groups.join(by_size(signs, signs_size), "node").join(by_size(sets, sets_size), "node")
            return sized_components(links.unionByName(_links_in_blocks(rest)))
        pairs = open_groups.where("component <> part").select(
            F.least("node", "chosen").alias("a"), F.greatest("node", "chosen").alias("b")
        )
        offered = _estimated(pairs.distinct(), signs, signs_size)
        fresh, fresh_size = measured(
            offered.join(by_size(tested, tested_size), ["a", "b"], "left_anti"), "pairs"
        )
        tested, tested_size = tested.unionByName(fresh), Size(*map(add, tested_size, fresh_size))
        links = materialise(links.unionByName(_verified(fresh, sets, sets_size)), "links")
    return None


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """The written signatures, and of each distinct set: set_key, label, first, component (a number).

    ``label`` is the smallest id that bears the set, ``first`` the id and digest of its first row: by id, nulls last, then digest.
    """
    signed = materialise(signatures(docs, id_column, text_column), "signatures")
    row = F.struct(F.col("id").isNull().alias("unnamed"), "id", "digest")
    distinct = (
        signed.where("set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("id").alias("label"),
            F.min(row).alias("first"),
            F.first("n_shingles").alias("n"),
            F.first("registers").alias("registers"),
        )
    )
    # numbered in the written table, so the numbers stay
    nodes = materialise(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = signed.where("set_key is not null").groupBy("id", "digest").agg(F.count(F.lit(1)).alias("rows"))
    repeats = not rows.where("rows > 1").isEmpty()
    labels = _links(docs, nodes, repeats, id_column, text_column)
    known = nodes.select("node", "set_key", "label", "first")
    if labels is None:
        return signed, known.withColumnRenamed("node", "component")
    placed = known.join(by_size(*labels), "node", "left")
    return signed, placed.withColumn("component", F.coalesce("component", "node")).drop("node")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, n_shingles, component_id (smallest id linked, over any number of links), kept for every document."""
    signed, sets = _grouped(docs, id_column, text_column)
    smallest = sets.groupBy("component").agg(F.min("label").alias("component_id"))
    named = sets.join(by_merge(smallest), "component").select("set_key", "component_id")
    # Copies share a set; frequent ones are spread.
    found = salted_join(signed.select("id", "n_shingles", "set_key"), named, ["set_key"])
    component = F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents, with all their columns, one row of each group: by id, nulls last, then by the text's digest.

    Groups are of rows, so texts that share an id, or have none, are told apart. Of rows without words one stays for each
    id, and all that have none.
    """
    signed, sets = _grouped(docs, id_column, text_column)
    wordless = signed.where("set_key is null")
    firsts = [
        sets.groupBy("component").agg(F.min("first").alias("first")).select("first.id", "first.digest"),
        wordless.where("id is not null").groupBy("id").agg(F.min("digest").alias("digest")),
        wordless.where("id is null").select("id", "digest").distinct(),
    ]
    chosen = reduce(DataFrame.unionByName, firsts)
    kept, kept_size = measured(
        chosen.select(F.col("id").alias("_kept_id"), F.col("digest").alias("_kept_digest")).distinct(),
        "kept",
    )
    same = F.col(id_column).eqNullSafe(F.col("_kept_id"))
    same &= _digest(text_column).eqNullSafe(F.col("_kept_digest"))
    left = docs.join(by_size(kept, kept_size), same, "left_semi")
    repeated = (
        signed.where("id is not null or set_key is not null")
        .groupBy("id", "digest")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )
    if repeated.isEmpty():
        return left
    worded = F.coalesce(F.col(text_column).rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    told_apart = F.col(id_column).isNotNull() | worded
    once = left.where(told_apart).dropDuplicates([id_column, text_column])
    return once.unionByName(left.where(~told_apart))
