"""Document quality by attention-based multiple-instance learning, trained in numpy.

A document is a bag of passages of ``Shape.passage`` words. A passage's features are the frequencies of its words'
written forms (case, letters, digits and punctuation, runs collapsed, hashed into buckets) and of words that repeat the
one or two before them. A word of more than ``PIECE`` characters counts as consecutive words of that many, so that a run
without white space is read to its end and fills passages like any other text. A layer encodes each passage, gated attention weighs the passages within the document, and
the weighted mean decides. Only document labels are given; which passages matter is learned.

Training reads up to ``Shape.sample`` documents of each label (ids with the smallest hashes that are not held out) and
``Shape.sample_passages`` passages, evenly spread, of each; scoring reads every passage of every document.

Rows: null and empty texts are a bag of one passage without words and get that score. Repeated rows each come out. Null ids
are not held out and not learned from; of labels only 0 and 1 are. Of an id with several texts one is learned from, of an id with
both labels none. Without any labels all scores are 0.5. Input columns other
than the id and the text are left out, so no name can clash.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopgrain.llm.batches import bounded, given_back, text_slices, texts_of
from shopgrain.llm.learning import Adam, held_out, one_of_each_id, sampled_ids
from shopgrain.operators.lookup import by_merge

THRESHOLD = 0.7
PIECE = 64  # characters of a run without white space that count as one word
CACHED_WORDS = 150_000  # a speed setting
_RUNS = (
    (re.compile(r"[^\W\d_]*[A-Z][^\W\d_a-z]+[^\W\d_]*"), "AA"),
    (re.compile(r"[A-Z][^\W\d_]*"), "Aa"),
    (re.compile(r"[^\W\d_A]+"), "a"),
    (re.compile(r"\d+"), "0"),
    (re.compile(r"([^\w\s])\1+"), r"\1\1"),
)


@dataclass(frozen=True)
class Shape:
    passage: int = 64
    buckets: int = 254
    encoded: int = 24
    attended: int = 16
    sample: int = 1500
    sample_passages: int = 32
    epochs: int = 12
    batch: int = 64
    rate: float = 0.005
    seed: int = 5

    @property
    def features(self) -> int:
        return self.buckets + 2


class Forms(dict):
    """By word: 47 bits that tell words apart, above 16 bits for the bucket of its written form."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        form = word
        for pattern, to in _RUNS:
            form = pattern.sub(to, form)
        raw = word.encode()
        own = (zlib.crc32(raw) << 15 | zlib.adler32(raw) & 0x7FFF) & ((1 << 47) - 1)
        value = own << 16 | zlib.crc32(form.encode()) % self.buckets
        self[word] = value
        return value


_FORMS: dict[int, Forms] = {}


def words_of(text: str) -> list[str]:
    """What is between white space, longer words in pieces of ``PIECE`` characters."""
    words = text.split()
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[at : at + PIECE] for w in words for at in range(0, len(w), PIECE)]


def passages_of(text: str, shape: Shape) -> np.ndarray:
    """Features of all passages of a text, one row each."""
    forms = _FORMS.setdefault(shape.buckets, Forms(shape.buckets))
    words = np.array([forms[w] for w in words_of(text)], np.int64)
    rows = max(1, -(-len(words) // shape.passage))
    if not len(words):
        return np.zeros((1, shape.features), np.float32)
    row = np.arange(len(words)) // shape.passage
    index = row * shape.features
    counts = np.bincount(index + (words & 0xFFFF), minlength=rows * shape.features)
    for back in (1, 2):
        same = np.flatnonzero(words[back:] == words[:-back]) + back
        counts += np.bincount(
            index[same] + shape.buckets + back - 1, minlength=rows * shape.features
        )
    sizes = np.minimum(shape.passage, len(words) - np.arange(rows) * shape.passage)
    return (counts.reshape(rows, -1) / sizes[:, None]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Encoder, gated attention and decision as plain arrays."""

    def __init__(self, shape: Shape):
        self.shape = shape
        rng = np.random.default_rng(shape.seed)
        f, e, a = shape.features, shape.encoded, shape.attended
        self.weights = {
            "encode": rng.normal(0, 0.3, (f, e)).astype(np.float32),
            "encode_bias": np.zeros(e, np.float32),
            "tanh": rng.normal(0, 0.3, (e, a)).astype(np.float32),
            "gate": rng.normal(0, 0.3, (e, a)).astype(np.float32),
            "attend": rng.normal(0, 0.3, a).astype(np.float32),
            "decide": rng.normal(0, 0.3, e).astype(np.float32),
            "decide_bias": np.zeros(1, np.float32),
        }

    def forward(self, passages: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """All steps for the bags that begin at ``starts``."""
        w = self.weights
        sizes = np.diff([*starts, len(passages)])
        h = np.tanh(passages @ w["encode"] + w["encode_bias"])
        t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
        energy = (t * g) @ w["attend"]
        e = np.exp(energy - np.repeat(np.maximum.reduceat(energy, starts), sizes))
        attention = e / np.repeat(np.add.reduceat(e, starts), sizes)
        bag = np.add.reduceat(attention[:, None] * h, starts)
        score = _sigmoid(bag @ w["decide"] + w["decide_bias"])
        return {"sizes": sizes, "h": h, "t": t, "g": g, "attention": attention, "bag": bag, "score": score}

    def gradients(
        self, passages: np.ndarray, starts: np.ndarray, wanted: np.ndarray, weight: np.ndarray
    ) -> dict[str, np.ndarray]:
        """Of the weighted mean cross entropy."""
        w, x = self.weights, self.forward(passages, starts)
        wrong = (x["score"] - wanted) * weight / len(wanted)
        to_bag = np.repeat(wrong[:, None] * w["decide"], x["sizes"], axis=0)
        to_attention = (to_bag * x["h"]).sum(axis=1)
        mean = np.add.reduceat(x["attention"] * to_attention, starts)
        to_energy = x["attention"] * (to_attention - np.repeat(mean, x["sizes"]))
        gated = to_energy[:, None] * w["attend"]
        to_t = gated * x["g"] * (1 - x["t"] ** 2)
        to_g = gated * x["t"] * x["g"] * (1 - x["g"])
        to_h = x["attention"][:, None] * to_bag + to_t @ w["tanh"].T + to_g @ w["gate"].T
        to_h *= 1 - x["h"] ** 2
        return {
            "encode": passages.T @ to_h,
            "encode_bias": to_h.sum(axis=0),
            "tanh": x["h"].T @ to_t,
            "gate": x["h"].T @ to_g,
            "attend": (x["t"] * x["g"]).T @ to_energy,
            "decide": x["bag"].T @ wrong,
            "decide_bias": np.array([wrong.sum()], np.float32),
        }


def train(bags: list[np.ndarray], wanted: np.ndarray, shape: Shape) -> Network:
    """Labels count alike, however many documents each has."""
    network = Network(shape)
    adam = Adam(network.weights, shape.rate)
    rng = np.random.default_rng(shape.seed)
    share = np.array([np.mean(wanted == 0), np.mean(wanted == 1)])
    weights = 0.5 / np.maximum(share, 1e-9)[wanted]
    for epoch in range(shape.epochs):
        adam.rate = shape.rate * (1 - epoch / shape.epochs)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), shape.batch):
            some = order[at : at + shape.batch]
            starts = np.cumsum([0, *[len(bags[i]) for i in some[:-1]]])
            passages = np.concatenate([bags[i] for i in some])
            adam.update(
                network.gradients(passages, starts, wanted[some], weights[some].astype(np.float32))
            )
    return network


def learn(
    docs: DataFrame, labels: DataFrame, shape: Shape, id_column: str, text_column: str, label_column: str
) -> Network | None:
    """A network from labelled documents that are not held out; None without any."""
    marked = labels.select(
        F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")
    ).where("label in (0, 1)")
    here = docs.select(F.col(id_column).alias("id")).where("id is not null").distinct()
    picked = sampled_ids(marked.join(by_merge(here), "id", "left_semi"), shape.sample)
    texts = bounded(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with given_back(_FORMS.clear):
            for batch in text_slices(batches, "text"):
                bags = []
                for text in texts_of(batch, "text"):
                    rows = passages_of(text, shape)
                    some = np.unique(
                        np.linspace(0, len(rows) - 1, min(len(rows), shape.sample_passages)).astype(int)
                    )
                    bags.append(rows[some].astype(np.float16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), pa.array(bags, pa.binary())],
                    ["id", "label", "bag"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = (
        texts.join(F.broadcast(picked), "id")  # ``sample`` ids of each label
        .select("id", "label", "text")
        .mapInArrow(cut, f"id {kind}, label int, bag binary")
    )
    found = one_of_each_id(chosen, "bag").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["id"], r["label"], bytes(r["bag"])))
    bags = [
        np.frombuffer(r["bag"], np.float16).reshape(-1, shape.features).astype(np.float32) for r in found
    ]
    return train(bags, np.array([r["label"] for r in found]), shape)


def score(
    docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, held_out, score, predicted of every document."""
    kind = docs.schema[id_column].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with given_back(_FORMS.clear):
            for batch in text_slices(batches, "text"):
                scores = pa.array(_scores(network, texts_of(batch, "text")), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("held_out"), scores],
                    ["id", "held_out", "score"],
                )

    read = bounded(docs).select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        held_out(F.col(id_column)).alias("held_out"),
    )
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return (
        read.mapInArrow(mark, f"id {kind}, held_out boolean, score double")
        .withColumn("predicted", predicted)
        .withColumnRenamed("id", id_column)
    )


def good_documents(
    docs: DataFrame, network: Network | None, least: float = THRESHOLD, text_column: str = "text"
) -> DataFrame:
    """The documents, with all their columns, that score ``least``; all of them without a network."""
    if network is None:
        return docs

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with given_back(_FORMS.clear):
            for batch in text_slices(batches, text_column):
                fits = _scores(network, texts_of(batch, text_column)) >= least
                yield batch.filter(pa.array(fits))

    return bounded(docs).mapInArrow(keep, docs.schema)


def _scores(network: Network | None, texts: list[str]) -> np.ndarray:
    if network is None:
        return np.full(len(texts), 0.5)
    bags = [passages_of(t, network.shape) for t in texts]
    starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
    return network.forward(np.concatenate(bags), starts)["score"].astype(np.float64)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    shape: Shape = Shape(),
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """Learns from the labelled documents that are not held out and scores all of them."""
    network = learn(docs, labels, shape, id_column, text_column, label_column)
    return score(docs, network, id_column, text_column)
