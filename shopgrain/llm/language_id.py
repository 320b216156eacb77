"""Language identification by a byte convolutional network, trained in numpy.

A text's lower-cased UTF-8 bytes are cut into windows of ``Shape.window`` bytes that overlap by the widest filter less one, so
every n-gram of the whole text is seen. Bytes are embedded, filters of several widths run over each window, each
filter's largest response feeds a softmax over the languages. A text's probabilities are the mean over its windows, by
their bytes.

Training reads up to ``Shape.sample`` texts of each language (ids with the smallest hashes that are not held out) and
``Shape.sample_windows`` windows, evenly spread, of each; that bounds what the driver holds by the number of languages.

Rows: null texts and texts without a letter are ``und`` with score 0, and so is every text if there is nothing to learn from.
Repeated rows each come out. Null ids are not held out and not learned from; of an id with several texts one is learned from,
of an id with several languages none. Input columns other than the id and the text (and the language, for learning) are left out, so no name can clash.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopgrain.llm.batches import bounded, given_back, text_slices, texts_of
from shopgrain.llm.learning import Adam, held_out, one_of_each_id, sampled_ids

UNKNOWN = "und"
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Shape:
    window: int = 256
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4, 5)
    filters: int = 12  # of each width
    sample: int = 400
    sample_windows: int = 6
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


def windows_of(text: str, shape: Shape) -> np.ndarray:
    """The whole text in rows of ``window`` bytes, the last one filled up with zeros."""
    data = text.lower().encode()
    step = shape.window - max(shape.widths) + 1
    rows = max(1, -(-(len(data) - shape.window) // step) + 1)
    padded = np.zeros((rows - 1) * step + shape.window, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, shape.window)[::step]


class Network:
    """Embedding, filters and softmax as plain arrays."""

    def __init__(self, shape: Shape, languages: list[str]):
        self.shape, self.languages = shape, languages
        rng = np.random.default_rng(shape.seed)
        widest, d = max(shape.widths), shape.embedding
        filters = shape.filters * len(shape.widths)
        # a narrow filter is a wide one whose last rows stay zero
        self.mask = np.zeros((widest, d, filters), np.float32)
        for i, width in enumerate(shape.widths):
            self.mask[:width, :, i * shape.filters : (i + 1) * shape.filters] = 1
        self.mask = self.mask.reshape(widest * d, filters)
        scale = 1 / np.sqrt(widest * d)
        self.weights = {
            "embedding": rng.normal(0, 1, (256, d)).astype(np.float32),
            "filters": (rng.normal(0, scale, (widest * d, filters)) * self.mask).astype(np.float32),
            "out": rng.normal(0, 0.1, (filters, len(languages))).astype(np.float32),
            "bias": np.zeros(len(languages), np.float32),
        }

    def _patches(self, windows: np.ndarray) -> np.ndarray:
        """Embedded bytes under the widest filter at each place: windows x places x (width * embedding)."""
        d, widest = self.shape.embedding, max(self.shape.widths)
        rows = self.weights["embedding"][windows].reshape(len(windows), -1)
        places = self.shape.window - widest + 1
        return np.lib.stride_tricks.as_strided(
            rows, (len(rows), places, widest * d), (rows.strides[0], 4 * d, 4), writeable=False
        )

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        w = self.weights
        patches = self._patches(windows)
        response = patches.reshape(-1, patches.shape[2]) @ w["filters"]
        pooled = response.reshape(len(windows), -1, w["out"].shape[0]).max(axis=1)
        logits = pooled @ w["out"] + w["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, windows: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy; only the place of each filter's largest response takes part."""
        w, n = self.weights, len(windows)
        patches = self._patches(windows)
        filters = w["filters"].shape[1]
        response = (patches.reshape(-1, patches.shape[2]) @ w["filters"]).reshape(n, -1, filters)
        place = response.argmax(axis=1)
        pooled = np.take_along_axis(response, place[:, None], 1)[:, 0]
        logits = pooled @ w["out"] + w["bias"]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        wrong = e / e.sum(axis=1, keepdims=True)
        wrong[np.arange(n), wanted] -= 1
        wrong /= n
        back = wrong @ w["out"].T
        seen = patches[np.arange(n)[:, None], place]  # windows x filters x patch
        d = self.shape.embedding
        embedding = np.zeros_like(w["embedding"])
        touched = (back[:, :, None] * w["filters"].T).reshape(n, filters, -1, d)
        for offset in range(touched.shape[2]):
            byte = windows[np.arange(n)[:, None], place + offset]
            np.add.at(embedding, byte, touched[:, :, offset])
        return {
            "out": pooled.T @ wrong,
            "bias": wrong.sum(axis=0),
            "filters": np.einsum("nf,nfp->pf", back, seen) * self.mask,
            "embedding": embedding,
        }


def train(windows: np.ndarray, wanted: np.ndarray, languages: list[str], shape: Shape) -> Network:
    network = Network(shape, languages)
    adam = Adam(network.weights, shape.rate)
    rng = np.random.default_rng(shape.seed)
    for epoch in range(shape.epochs):
        adam.rate = shape.rate * (1 - epoch / shape.epochs)
        order = rng.permutation(len(windows))
        for at in range(0, len(order), shape.batch):
            some = order[at : at + shape.batch]
            adam.update(network.gradients(windows[some], wanted[some]))
    return network


def learn(
    docs: DataFrame, shape: Shape, id_column: str, text_column: str, lang_column: str
) -> Network | None:
    """A network for the languages of the rows that are not held out; None without any."""
    usable = bounded(docs).where(F.col(text_column).isNotNull() & F.col(lang_column).isNotNull())
    picked = sampled_ids(
        usable.select(F.col(id_column).alias("id"), F.col(lang_column).alias("label")), shape.sample
    )
    texts = usable.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with given_back():
            for batch in text_slices(batches, "text"):
                pieces = []
                for text in texts_of(batch, "text"):
                    rows = windows_of(text, shape)
                    some = np.unique(
                        np.linspace(0, len(rows) - 1, min(len(rows), shape.sample_windows)).astype(int)
                    )
                    pieces.append(rows[some].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), pa.array(pieces, pa.binary())],
                    ["id", "label", "bytes"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in picked.schema}
    chosen = (
        texts.join(F.broadcast(picked), "id")  # ``sample`` ids of each language
        .select("id", "label", "text")
        .mapInArrow(cut, f"id {kinds['id']}, label {kinds['label']}, bytes binary")
    )
    found = one_of_each_id(chosen, "bytes").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["label"], r["id"], bytes(r["bytes"])))
    languages = sorted({r["label"] for r in found})
    rows = [np.frombuffer(r["bytes"], np.uint8).reshape(-1, shape.window) for r in found]
    wanted = [np.full(len(x), languages.index(r["label"])) for r, x in zip(found, rows)]
    return train(np.concatenate(rows), np.concatenate(wanted), languages, shape)


def predict(
    docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, held_out, lang_pred, score of every document."""
    kind = docs.schema[id_column].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with given_back():
            for batch in text_slices(batches, "text", SLICE_BYTES):
                named, scores = _predicted(network, texts_of(batch, "text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("held_out"),
                        pa.array(named, pa.string()),
                        pa.array(scores, pa.float64()),
                    ],
                    ["id", "held_out", "lang_pred", "score"],
                )

    read = bounded(docs).select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        held_out(F.col(id_column)).alias("held_out"),
    )
    schema = f"id {kind}, held_out boolean, lang_pred string, score double"
    return read.mapInArrow(label, schema).withColumnRenamed("id", id_column)


def known_language(
    docs: DataFrame, network: Network | None, least: float, text_column: str = "text"
) -> DataFrame:
    """The documents, with all their columns, whose language is known with a score of ``least``.

    ``und`` goes. Texts that do not fill a window are too short for the score to tell, and stay if they have a letter.
    Without a network nothing is known about languages, and all documents stay.
    """
    if network is None:
        return docs

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with given_back():
            for batch in text_slices(batches, text_column, SLICE_BYTES):
                texts = texts_of(batch, text_column)
                named, scores = _predicted(network, texts)
                fits = [
                    n != UNKNOWN and (s >= least or len(t.encode()) < network.shape.window)
                    for n, s, t in zip(named, scores, texts)
                ]
                yield batch.filter(pa.array(fits, pa.bool_()))

    return bounded(docs).mapInArrow(keep, docs.schema)


def _predicted(network: Network | None, texts: list[str]) -> tuple[list[str], list[float]]:
    named, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if network is None:
        return named, scores
    shape = network.shape
    known = [i for i, t in enumerate(texts) if any(c.isalpha() for c in t)]
    cut = [windows_of(texts[i], shape) for i in known]
    if not cut:
        return named, scores
    windows = np.concatenate(cut)
    found = np.concatenate(
        [network.probabilities(windows[at : at + 64]) for at in range(0, len(windows), 64)]
    )
    weights = np.count_nonzero(windows, axis=1).astype(np.float64)[:, None]
    starts = np.cumsum([0, *[len(c) for c in cut[:-1]]])
    mean = np.add.reduceat(found * weights, starts) / np.add.reduceat(weights, starts)
    for i, p in zip(known, mean):
        named[i] = network.languages[int(p.argmax())]
        scores[i] = float(min(p.max(), 1.0))
    return named, scores


def identify(
    docs: DataFrame,
    shape: Shape = Shape(),
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """Learns from the documents that are not held out and predicts all of them."""
    return predict(docs, learn(docs, shape, id_column, text_column, lang_column), id_column, text_column)
