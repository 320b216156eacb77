import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import order_minhash
from shopgrain.llm.order_minhash import Sketcher
from tests.llm.helpers import ROWS, each_case

SKETCH = Sketcher()


def sample(rng, n):
    return "".join(rng.choices("abcdefghij klmnop", k=n))


def alike(one, other, sketcher=SKETCH):
    return float((sketcher.values(one) == sketcher.values(other)).mean())


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 30, 300, 5000])
def test_equal_texts_are_alike_and_others_are_not(n):
    rng = random.Random(n)
    text = sample(rng, n)
    assert alike(text, text) == 1.0
    assert len(SKETCH.fingerprint(text)) == 4 * SKETCH.slots
    if n >= 30:
        assert alike(text, sample(rng, n)) < 0.2


def test_likeness_falls_with_edits():
    rng = random.Random(1)
    means = []
    for edits in (0, 5, 40, 200):
        found = []
        for _ in range(20):
            text = sample(rng, 2000)
            other = list(text)
            for _ in range(edits):
                other[rng.randrange(2000)] = rng.choice("XYZ")
            found.append(alike(text, "".join(other)))
        means.append(np.mean(found))
    assert means[0] == 1 and means == sorted(means, reverse=True) and means[-1] < 0.3


def test_order_counts():
    """Two halves changed over keep nearly all k-mers, but pairs across the halves turn round."""
    rng = random.Random(2)
    near, far = [], []
    for _ in range(30):
        text = sample(rng, 2000)
        near.append(alike(text, text[1000:] + text[:1000]))
        far.append(alike(text, text[1000:] + text[:1000], Sketcher(picks=1)))
    assert np.mean(near) < 0.75 < 0.9 < np.mean(far)


def test_repeats_count():
    assert alike("abcdefgh " * 50, "abcdefgh " * 200) < 0.9


def edited_by_hand(texts):
    """By position: the text, its edited text and the next one's."""
    order = sorted(range(len(texts)), key=lambda i: (-texts[i][0], texts[i][1]))
    out = []
    for k, i in enumerate(order):
        doc, text = texts[i]
        after = texts[order[(k + 1) % len(order)]][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), SKETCH.fingerprint(text),
                    SKETCH.fingerprint(edited), alike(text, edited), alike(text, after)))
    return sorted(out)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted(map(tuple, order_minhash.edited_fingerprints(docs).collect()))
    assert found == edited_by_hand(texts)


def test_awkward_rows(spark):
    found = each_case(spark, order_minhash.edited_fingerprints).collect()
    assert len(found) == len(ROWS)
    named = [(i, t or "") for i, t, *_ in ROWS if i is not None]
    by_hand = {(r[0], r[1], r[3]) for r in edited_by_hand(named)}
    assert {(r.doc_id, r.n_chars, r.fingerprint) for r in found if r.doc_id is not None} == by_hand
    (nameless,) = [r for r in found if r.doc_id is None]
    text, after = ROWS[7][1], ROWS[9][1]  # after the last comes the first
    cut = len(text) // 3
    edited = text[: len(text) - cut] + after[:cut]
    assert nameless.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(4, "abcdef")], "doc_id bigint, text string")
    (row,) = order_minhash.edited_fingerprints(docs).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_fingerprints_and_likeness(spark):
    each_case(spark, order_minhash.fingerprints)
    docs = spark.createDataFrame([(1, "some text here"), (2, "some text there")], "doc_id bigint, text string")
    one, other = order_minhash.fingerprints(docs).orderBy("doc_id").collect()
    both = spark.createDataFrame([(one.fingerprint, other.fingerprint)], "a string, b string")
    found = both.select(
        order_minhash.likeness(F.col("a"), F.col("b"), SKETCH.slots),
        order_minhash.likeness(F.col("a"), F.col("a"), SKETCH.slots),
    ).first()
    assert found[0] == pytest.approx(alike("some text here", "some text there")) and found[1] == 1.0


def likeness_with_independent_orders(one, other, k=8, picks=2, slots=256):
    """Order MinHash as it is defined: every slot orders all numbered k-mers by a hash of its own."""
    values = []
    for text in (one, other):
        seen, elements = {}, []
        for i in range(len(text) - k + 1):
            kmer = text[i : i + k]
            seen[kmer] = seen.get(kmer, -1) + 1
            elements.append(f"{kmer}#{seen[kmer]}".encode())
        rows = []
        for slot in range(slots):
            key = slot.to_bytes(8, "little")
            ranked = sorted(range(len(elements)), key=lambda i: hashlib.blake2b(elements[i], digest_size=8, key=key).digest())
            rows.append(tuple(text[i : i + k] for i in sorted(ranked[:picks])))
        values.append(rows)
    return sum(a == b for a, b in zip(*values)) / slots


@pytest.mark.parametrize("n", [60, 100, 200])
def test_dealing_one_hash_to_slots_does_not_bias_the_likeness(n):
    """Against independent orders for every slot, texts of all lengths."""
    rng = random.Random(n)
    dealt, independent = [], []
    for _ in range(30):
        text = sample(rng, n)
        other = list(text)
        other[rng.randrange(n)] = "Z"
        dealt.append(alike(text, "".join(other)))
        independent.append(likeness_with_independent_orders(text, "".join(other)))
    assert np.mean(dealt) == pytest.approx(np.mean(independent), abs=0.05)
