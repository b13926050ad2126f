"""Byte-level BPE: texts to token ids by the ranks of a public vocabulary, and back.

A text is split by the vocabulary's pattern into pieces, each encoded on its own: a piece that is a token is that token; any other
begins as single bytes, of which the neighbours whose joined bytes have the least rank (of several, the leftmost) are joined until
no two neighbours are a token. A segment tree over the piece's byte positions holds the rank of each part with the next one, and in
each node the least below it: the leftmost least is found by going down from the root, and a merge writes three leaves (the part that
grew, the one that went, the live neighbour before) and the nodes above them. So a piece of n bytes takes n log n steps, a text
without white space too. Pieces of up to LONG bytes are encoded many at once, their trees being rows of one numpy array; a longer one
has a tree of its own. Each distinct piece is encoded once while a task's memory of pieces (KNOWN of them) lasts; what it forgets it
encodes again.

Rows are independent: nothing is shuffled, and a task holds a slice of texts, or one text, at once. The vocabulary (its ranks and the
pairs of tokens that join to a token) is broadcast: it has the size of its file, whatever the input.

Nulls: a null text encodes to no tokens, as an empty one does; null ids decode to empty bytes. Ties of rank go to the leftmost pair.
Repeated rows get equal results. An empty table gives an empty one. A very long text is one row's work. Other columns stay, whatever
their names, but for one called like the new column, which replaces it. Special tokens are ordinary text. Ids that the
vocabulary doesn't have raise an error.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsieve.llm.common import SLICE_BYTES, binary_array, gather, ranges, text_slices

LONG = 512
"""Bytes above which a piece has a tree of its own."""
KNOWN = 1 << 20
"""Distinct pieces that a task remembers."""
AT_ONCE = 1 << 21
"""Leaves of the trees that are worked on together, and matches that are taken from a text at once."""
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Ranks, which are the ids, of byte strings, and the pairs of tokens that join to a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        self.known = np.array([bool(t) for t in tokens])
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        splits = ((ranks.get(t[:k]), ranks.get(t[k:]), i) for t, i in ranks.items() for k in range(1, len(t)))
        pairs = np.array(sorted((a << 32 | b, i) for a, b, i in splits if a is not None and b is not None), dtype=np.int64).reshape(-1, 2)
        self.pairs, self.joined = np.ascontiguousarray(pairs[:, 0]), np.append(pairs[:, 1], NONE).astype(np.int32)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each two parts joined; NONE where they are no token, or where b is no part (-1)."""
        if not len(self.pairs):
            return np.full(len(a), NONE)
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (b >= 0), self.joined[at], NONE)


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """A file with a token in base64 and its rank on each line; all 256 single bytes are among them."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}, pattern)


def encode_one(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """A piece's tokens by one tree, in plain lists."""
    n = len(piece)
    width = 1 << max(n - 1, 1).bit_length()
    none = int(NONE)
    tree = [none] * (2 * width)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # after a part: where the next one begins, n after the last
    rank = lambda i: ranks.get(piece[i : after[after[i]]], none) if after[i] < n else none
    tree[width : width + n] = map(rank, range(n))
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(at: int, value: int) -> None:
        at += width
        tree[at] = value
        while at > 1:
            at >>= 1
            low = min(tree[2 * at], tree[2 * at + 1])
            if tree[at] == low:
                return
            tree[at] = low

    while (least := tree[1]) != none:
        at = 1
        while at < width:
            at *= 2
            at += tree[at] != least
        at -= width
        gone = after[at]
        after[at] = after[gone]
        if after[at] < n:
            before[after[at]] = at
        put(gone, none)
        put(at, rank(at))
        if before[at] >= 0:
            put(before[at], rank(before[at]))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


def encode_rows(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of many pieces, and how many each has: trees side by side, each of which does a merge in each round."""
    n = np.diff(offsets)
    pieces, most = len(n), int(n.max())
    width = 1 << max(most - 1, 1).bit_length()
    row = np.repeat(np.arange(pieces), n)
    place = ranges(np.zeros(pieces, dtype=np.int64), n)
    # a column more for "no part", on both sides: before the first is `width`, after the last too
    part = np.full((pieces, width + 1), -1, dtype=np.int32)
    part[row, place] = vocabulary.of_byte[data]
    before = np.tile(np.append(width, np.arange(width)).astype(np.int32), (pieces, 1))
    after = np.tile(np.append(np.arange(1, width + 1), width).astype(np.int32), (pieces, 1))
    after[np.arange(pieces), n - 1] = width
    tree = np.full((pieces, 2 * width), NONE, dtype=np.int32)
    tree[:, width:] = vocabulary.join(part[:, :-1].ravel(), part[:, 1:].ravel()).reshape(pieces, width)
    for level in range(width.bit_length() - 2, -1, -1):
        below = tree[:, 2 << level : 4 << level]
        tree[:, 1 << level : 2 << level] = np.minimum(below[:, ::2], below[:, 1::2])

    def put(r: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        node = at + width
        tree[r, node] = value
        for _ in range(width.bit_length() - 1):
            node >>= 1
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

    live = np.flatnonzero(tree[:, 1] != NONE)
    while len(live):
        least = tree[live, 1]
        node = np.ones(len(live), dtype=np.int64)
        for _ in range(width.bit_length() - 1):
            node *= 2
            node += tree[live, node] != least
        at = node - width
        gone = after[live, at]
        follow = after[live, gone]
        after[live, at] = follow
        before[live, follow] = at  # the column for "no part" may be written: nothing reads it
        part[live, at], part[live, gone] = least, -1
        put(live, gone, np.full(len(live), NONE))
        put(live, at, vocabulary.join(least, part[live, follow]))
        earlier = before[live, at]
        has = earlier < width
        put(live[has], earlier[has], vocabulary.join(part[live[has], earlier[has]], least[has]))
        live = live[tree[live, 1] != NONE]
    keep = part >= 0
    return part[keep], keep.sum(axis=1)


class Numbers(dict):
    """A number for each piece: a new one gets the next, and is listed in `new`."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number


class Encoder:
    """A task's memory of pieces: under its number, each has its tokens in one flat array."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.split = vocabulary, regex.compile(vocabulary.pattern)
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.flat, self.offsets = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _learn(self) -> None:
        raw = [p.encode() for p in self.numbers.new]
        self.numbers.new.clear()
        size = np.array([len(p) for p in raw])
        whole = np.array([self.vocabulary.ranks.get(p, -1) for p in raw])
        n = (whole >= 0).astype(np.int64)
        found = [(np.flatnonzero(n), whole[whole >= 0])]
        for i in np.flatnonzero((whole < 0) & (size > LONG)):
            found.append((np.array([i]), np.array(encode_one(raw[i], self.vocabulary.ranks))))
            n[i] = len(found[-1][1])
        rest = np.flatnonzero((whole < 0) & (size <= LONG))
        width = 1 << np.ceil(np.log2(np.maximum(size[rest], 2))).astype(np.int64)
        for w in np.unique(width):
            these, most = rest[width == w], max(1, AT_ONCE // int(w))
            for some in (these[i : i + most] for i in range(0, len(these), most)):
                ids, n[some] = encode_rows(np.frombuffer(b"".join(raw[i] for i in some), dtype=np.uint8), np.concatenate([[0], np.cumsum(size[some])]), self.vocabulary)
                found.append((some, ids))
        offsets = np.concatenate([[0], np.cumsum(n)])
        flat = np.zeros(offsets[-1], dtype=np.int32)
        for which, ids in found:
            flat[ranges(offsets[which], n[which])] = ids
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
        self.flat = np.concatenate([self.flat, flat])

    def _pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= AT_ONCE:
            yield self.split.findall(text)
            return
        matches = (m[0] for m in self.split.finditer(text))
        while some := list(islice(matches, AT_ONCE)):
            yield some

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts, one after another, and their offsets."""
        if len(self.numbers) > KNOWN:
            self._forget()
        number = self.numbers.__getitem__
        of = [[np.fromiter(map(number, some), dtype=np.int64) for some in self._pieces(t)] for t in texts]
        if self.numbers.new:
            self._learn()
        pieces = np.concatenate([x for xs in of for x in xs] or [np.zeros(0, dtype=np.int64)])
        n = self.offsets[pieces + 1] - self.offsets[pieces]
        ends = np.concatenate([[0], np.cumsum(n)])
        return self.flat[ranges(self.offsets[pieces], n)], ends[np.concatenate([[0], np.cumsum([sum(map(len, xs)) for xs in of])])]


def _share(spark: SparkSession, vocabulary: Vocabulary) -> Broadcast[Vocabulary]:
    return spark.sparkContext.broadcast(vocabulary)


def _mapped(df: DataFrame, source: str, result: str, kind: T.DataType, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], drop: bool) -> DataFrame:
    """df with a column that `run` makes of another one; `run` takes (row, value) and gives (row, value), row being all of df's columns."""
    keep = [c for c in df.columns if c != result and not (drop and c == source)]
    rows = df.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep))).alias("row"), F.col(f"`{source}`").alias("value"))
    out = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("value", kind)]))
    return out.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)), F.col("value").alias(result))


def _batch(rows: pa.Array, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([rows, values], names=["row", "value"])


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with its text_col replaced by ids_col, an array of the text's tokens."""
    shared = _share(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            texts = batch.column("value")
            for i, j, _, _ in text_slices(texts):
                ids, offsets = encoder.encode(texts.slice(i, j - i).fill_null("").to_pylist())
                yield _batch(batch.column("row").slice(i, j - i), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())))

    return _mapped(docs, text_col, ids_col, T.ArrayType(T.IntegerType()), run, drop=True)


def decode(tokens: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """tokens with bytes_col, the bytes that ids_col's tokens stand for: text in UTF-8 if the ids are those of a text."""
    shared = _share(tokens.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            column, most = batch.column("value"), max(1, SLICE_BYTES // 4)
            n = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
            group = np.concatenate([[0], np.cumsum(n)]) // most
            edges = [0, *(np.flatnonzero(np.diff(group[:-1])) + 1), len(n)]
            for i, j in zip(edges, edges[1:]):
                if j == i:
                    continue
                ids = column.slice(i, j - i).flatten().to_numpy().astype(np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(v.known) or not v.known[ids].all()):
                    raise ValueError("an id that the vocabulary doesn't have")
                data, ends = gather(v.data, v.offsets[ids], v.offsets[ids + 1])
                yield _batch(batch.column("row").slice(i, j - i), binary_array(data, ends[np.concatenate([[0], np.cumsum(n[i:j])])]))

    return _mapped(tokens, ids_col, bytes_col, T.BinaryType(), run, drop=False)
