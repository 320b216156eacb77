"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

Each word keeps a complete binary tree whose leaves are ``rank * width + position`` of the pair that begins
at a position and whose inner nodes hold the smaller child. The root is therefore the leftmost pair of the
lowest rank. A merge changes three leaves (the pair before, the merged pair, the pair taken away) and the
paths above them; a word is done when its root holds no rank. Words of about one length share arrays, so one
numpy step merges a pair in every unfinished word; a very long word has a tree of its own.

Rows: null text is empty text, which has no ids and decodes to empty text. Repeated rows are encoded as
often as they come. Input columns other than the id and the text are left out, so no name can clash.
"""

import json
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from shopgrain.llm.batches import bounded, give_back, given_back, text_slices, texts_of

NO_PAIR = np.int64(1) << 60
LONGEST_SHARED = 256  # symbols; longer words get a tree of their own
CACHED_WORDS = 150_000  # a speed setting: words over it are encoded again

_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_LETTERS_1, _DIGITS_1 = "a-zA-Zª\xb5ºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
_NARROW = re.compile(  # the words of texts below U+0100, whatever the Unicode version
    f"{_CONTRACTIONS}|[{_LETTERS_1}]+|[{_DIGITS_1}]|[^\t-\r \x85\xa0{_LETTERS_1}{_DIGITS_1}]+"
)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class PairTable:
    """Ranks by pair of symbol ids: open addressing, looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, base: int):
        self.base = base
        keys = left.astype(np.int64) * base + right
        bits = max(4, int(np.ceil(np.log2(len(keys) * 6 + 1))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.zeros(1 << bits, np.int64)
        todo, slots = np.arange(len(keys)), self._slots(keys)
        while len(todo):
            free = self.keys[slots] < 0
            first = np.unique(slots[free], return_index=True)[1]
            placed = np.flatnonzero(free)[first]
            self.keys[slots[placed]] = keys[todo[placed]]
            self.ranks[slots[placed]] = todo[placed]
            left_over = np.ones(len(todo), bool)
            left_over[placed] = False
            taken = self.keys[slots] != keys[todo]
            todo, slots = todo[left_over], np.where(taken, slots + 1, slots)[left_over] & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.base + right
        slots = self._slots(keys)
        out = np.full(len(keys), NO_PAIR, np.int64)
        at = np.arange(len(keys))
        while len(at):
            found = self.keys[slots]
            hit = found == keys[at]
            out[at[hit]] = self.ranks[slots[hit]]
            on = (found >= 0) & ~hit
            at, slots = at[on], (slots[on] + 1) & self.mask
        return out


class Bpe:
    """A byte-level BPE vocabulary with word ends, read from a tokenizer's JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not suffix or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not a lower-casing BPE vocabulary with word ends")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = np.full(size, "", object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.pairs = PairTable(left, right, size)
        self.merged = np.array([vocab["".join(p)] for p in pairs], np.int32)
        letters = _byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.last = np.array([vocab[x + suffix] for x in letters], np.int32)
        longest_first = sorted(self.special, key=len, reverse=True)
        self._split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self._marks = tuple(longest_first)
        library = Tokenizer.from_file(path)  # only for its Unicode tables
        self._normalizer, self._pre_tokenizer = library.normalizer, library.pre_tokenizer
        self._byte_of = {x: b for b, x in enumerate(letters)}
        self._ids: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """Normalised words of a text; special tokens stand as they are."""
        if any(m in text for m in self._marks):
            out = []
            for k, part in enumerate(self._split.split(text)):
                out += [part] if k % 2 else self._plain_words(part)
            return out
        return self._plain_words(text)

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii() or max(text) <= "\xff":
            return _NARROW.findall(text.lower())
        found = self._pre_tokenizer.pre_tokenize_str(self._normalizer.normalize_str(text))
        return [bytes([self._byte_of[x] for x in word]).decode() for word, _ in found]

    def encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin (one more at the end)."""
        split = [self.words(t) for t in texts]
        distinct = set().union(*split)
        known = self._ids
        new = [w for w in distinct if w not in known]
        if len(known) + len(new) > CACHED_WORDS:
            known = self._ids = {w: known[w] for w in distinct if w in known}
        known.update(zip(new, self._encode_words(new)))
        parts = [b"".join([known[w] for w in words]) for words in split]
        ids = np.frombuffer(b"".join(parts), np.int32)
        starts = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) // 4 for p in parts], out=starts[1:])
        return ids, starts

    def forget(self) -> None:
        """Drop the cached words."""
        self._ids = {}

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: tokens joined by one space, as there is no decoder in the file."""
        return " ".join(self.tokens[ids].tolist())

    def _encode_words(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        classes: dict[int, list[int]] = {}
        raw = [w.encode() for w in words]
        for k, w in enumerate(words):
            if w in self.special:
                out[k] = np.int32(self.special[w]).tobytes()
            else:
                classes.setdefault(max(2, 1 << (len(raw[k]) - 1).bit_length()), []).append(k)
        for width, members in classes.items():
            if width > LONGEST_SHARED:
                for k in members:
                    out[k] = self._merge_long(raw[k]).tobytes()
                continue
            rows = max(1, (1 << 16) // width)
            for at in range(0, len(members), rows):
                some = members[at : at + rows]
                symbols, counts = self._merge_shared([raw[k] for k in some], width)
                ends = np.cumsum(counts)
                for k, begin, end in zip(some, ends - counts, ends):
                    out[k] = symbols[begin:end].tobytes()
        return out

    def _symbols(self, data: np.ndarray) -> np.ndarray:
        symbols = self.inner[data]
        symbols[-1] = self.last[data[-1]]
        return symbols

    def _merge_shared(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in a row, and how many each word has."""
        rows = len(words)
        length = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        column = np.arange(width)
        inside = column < length[:, None]
        symbol = np.full((rows, width), -1, np.int32)
        symbol[inside] = self.inner[flat]
        each = np.arange(rows)
        last = np.cumsum(length) - 1
        symbol[each, length - 1] = self.last[flat[last]]
        # one slot before and one after the row stand for "none"
        after = np.where(column + 1 < length[:, None], column + 1, width)
        before = np.tile(column - 1, (rows, 1))

        tree = np.full((rows, 2 * width), NO_PAIR, np.int64)
        row, col = np.nonzero(inside[:, 1:])
        rank = self.pairs.ranks_of(symbol[row, col], symbol[row, col + 1])
        tree[row, width + col] = np.where(rank < NO_PAIR, rank * width + col, NO_PAIR)
        size = width
        while size > 1:
            level = tree[:, size : 2 * size]
            tree[:, size // 2 : size] = np.minimum(level[:, ::2], level[:, 1::2])
            size //= 2

        def set_leaves(rows_at, leaf, value):
            tree[rows_at, leaf] = value
            node = leaf >> 1
            while node[0]:
                tree[rows_at, node] = np.minimum(
                    tree[rows_at, 2 * node], tree[rows_at, 2 * node + 1]
                )
                node = node >> 1

        open_rows = each
        while True:
            top = tree[open_rows, 1]
            more = top < NO_PAIR
            if not more.any():
                break
            open_rows, top = open_rows[more], top[more]
            pos = top % width
            gone = after[open_rows, pos]
            follow = after[open_rows, gone]
            symbol[open_rows, pos] = self.merged[top // width]
            symbol[open_rows, gone] = -1
            after[open_rows, pos] = follow
            has = follow < width
            before[open_rows[has], follow[has]] = pos[has]
            set_leaves(open_rows, width + gone, NO_PAIR)
            value = np.full(len(pos), NO_PAIR, np.int64)
            r, p = open_rows[has], pos[has]
            value[has] = self._keys(symbol[r, p], symbol[r, follow[has]], p, width)
            set_leaves(open_rows, width + pos, value)
            ahead = before[open_rows, pos]
            has = ahead >= 0
            if has.any():
                r, p, a = open_rows[has], pos[has], ahead[has]
                set_leaves(r, width + a, self._keys(symbol[r, a], symbol[r, p], a, width))
        left = symbol >= 0
        return symbol[left], left.sum(1)

    def _keys(self, left, right, pos, width) -> np.ndarray:
        rank = self.pairs.ranks_of(left, right)
        return np.where(rank < NO_PAIR, rank * width + pos, NO_PAIR)

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, with plain lists."""
        symbols = self._symbols(np.frombuffer(word, np.uint8))
        n = len(symbols)
        width = 1 << (n - 1).bit_length()
        none = int(NO_PAIR)
        leaves = np.full(width, none, np.int64)
        leaves[: n - 1] = self._keys(symbols[:-1], symbols[1:], np.arange(n - 1), width)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [none, *np.concatenate(levels[::-1]).tolist()]
        symbol = symbols.tolist()
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        known: dict[tuple[int, int], int] = {}

        def key(a: int, b: int) -> int:
            pair = (symbol[a], symbol[b])
            if pair not in known:
                known[pair] = int(self.pairs.ranks_of(np.array(pair[:1]), np.array(pair[1:]))[0])
            return known[pair] * width + a if known[pair] < none else none

        def set_leaf(pos: int, value: int) -> None:
            node = width + pos
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        while tree[1] < none:
            rank, pos = divmod(tree[1], width)
            gone = after[pos]
            follow = after[gone]
            symbol[pos], symbol[gone] = int(self.merged[rank]), -1
            after[pos] = follow
            set_leaf(gone, none)
            if follow >= 0:
                before[follow] = pos
            set_leaf(pos, key(pos, follow) if follow >= 0 else none)
            if before[pos] >= 0:
                set_leaf(before[pos], key(before[pos], pos))
        return np.array([s for s in symbol if s >= 0], np.int32)


@cache
def model(path: str) -> Bpe:
    """One model per file and worker."""
    made = Bpe(path)
    give_back()  # what reading the file took
    return made


def encode_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every text's ids and the text that the ids decode to: id, ids, decoded."""
    kind = docs.schema[id_column].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        with given_back(bpe.forget):
            for batch in text_slices(batches, "text"):
                ids, starts = bpe.encode(texts_of(batch, "text"))
                decoded = [bpe.decode(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                lists = pa.ListArray.from_arrays(
                    pa.array(starts, pa.int32()), pa.array(ids, pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), lists, pa.array(decoded, pa.string())],
                    ["id", "ids", "decoded"],
                )

    read = bounded(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    done = read.mapInArrow(encode, f"id {kind}, ids array<int>, decoded string")
    return done.withColumnRenamed("id", id_column)


def decode_ids(coded: DataFrame, path: str, ids_column: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text that a column of ids decodes to; null ids give null."""

    @F.pandas_udf("string")
    def decode(ids):
        bpe = model(path)
        return ids.map(lambda x: None if x is None else bpe.decode(np.asarray(x, np.int64)))

    return coded.withColumn(into, decode(ids_column))
