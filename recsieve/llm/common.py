"""What several operators of this subpackage share: checkpoints, row keys, Arrow slices, word hashes in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from recsieve.sources.staging import checkpoint_dir as checkpoint_dir
from recsieve.sources.staging import cut as cut

SLICE_BYTES = 1 << 21
"""Texts are hashed in slices of about this many bytes (a longer text is a slice of its own)."""


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two longs that tell rows apart. Rows equal in id and text share a key: all operators give those equal results."""
    return [F.xxhash64(F.lit("id"), F.col(id_col)).alias("_k1"), F.xxhash64(F.lit("text"), F.col(text_col)).alias("_k2")]


KEY = ["_k1", "_k2"]

RUN = 128
"""Elements that running() folds in one piece."""


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once: bound to a lambda's variable."""
    return F.transform(F.array(value), then)[0]


def running(xs: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array of longs, op folded over it and all before; op takes a null for nothing, and is associative.

    A fold that appends to an array copies it each time: pieces of RUN elements are folded, then what they come to, so that
    the time grows with the array's length and not with its square.
    """
    none = F.array().cast("array<bigint>")
    fold = lambda a: F.aggregate(a, none, lambda acc, x: F.concat(acc, F.array(op(F.get(acc, F.size(acc) - 1), x))))

    def whole(v: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / RUN).cast("int") - 1), lambda b: fold(F.slice(v, b * RUN + 1, F.lit(RUN))))
        after = lambda ps: fold(F.transform(ps, lambda p: F.element_at(p, -1)))
        return let(pieces, lambda ps: let(after(ps), lambda c: F.flatten(F.transform(ps, lambda p, i: F.transform(p, lambda x: op(F.get(c, i - 1), x))))))

    return F.when(F.size(xs) > 0, let(xs, whole)).otherwise(none)


def merged(spans: Column, touching: bool) -> Column:
    """Spans (start, end), sorted by start, with those that overlap, or with `touching` meet, as one."""
    ends = running(F.transform(spans, lambda x: x["end"].cast("long")), lambda a, x: F.greatest(a, x))

    def groups(s: Column, e: Column) -> Column:
        fresh = lambda i: (F.get(s, i)["start"] > F.get(e, i - 1)) if touching else (F.get(s, i)["start"] >= F.get(e, i - 1))
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | fresh(i))
        return let(first, lambda f: F.transform(f, lambda i, k: F.struct(F.get(s, i)["start"].alias("start"), F.get(e, F.coalesce(F.get(f, k + 1), F.size(s)) - 1).cast("int").alias("end"))))

    found = let(spans, lambda s: let(ends, lambda e: groups(s, e)))
    return F.when(F.size(spans) > 0, found).otherwise(F.array().cast("array<struct<start:int,`end`:int>>"))


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser: spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers, the same on all machines."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = constants(256, 11)
_BASE = {"byte": 0xD1342543DE82EF95, "word": 0xAF251AF3B0F025B5}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, n of them at least."""
    if kind not in _POWERS or len(_POWERS[kind][0]) < n:
        size = max(n, SLICE_BYTES)
        base = _BASE[kind]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[kind] = (both[0], both[1])
    return _POWERS[kind]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of some texts: byte ranges, and where each text's words begin in `ptr`.

    `between`: which bytes part words, where they are others.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, between: np.ndarray = _SPACE):
        self.data = data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        space = between[data]
        before = np.ones(n + 1, dtype=bool)
        before[1:] = space
        before[offsets] = True
        after = np.ones(n + 1, dtype=bool)
        after[:n] = space
        after[offsets] = True
        self.starts = np.flatnonzero(~space & before[:n])
        self.ends = np.flatnonzero(~space & after[1:]) + 1
        self.ptr = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.data)
        up, down = _powers("byte", n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * up[:n], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def texts(self) -> int:
        return len(self.offsets) - 1

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts()), np.diff(self.ptr))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """For each i with k hashes from i on: a hash of h[i:i+k]. Texts' bounds are the caller's matter."""
    n = len(h)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers("word", n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * up[:n], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: n - k + 1] + np.uint64(k))


def full_starts(ptr: np.ndarray, k: int) -> np.ndarray:
    """The word indices at which k words of one text begin."""
    n = np.maximum(np.diff(ptr) - k + 1, 0)
    return ranges(ptr[:-1], n)


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (n[0] of them), first[1], ..."""
    n = n.astype(np.int64)
    total = int(n.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(first.astype(np.int64) - (np.cumsum(n) - n), n)
    return shift + np.arange(total)


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about `most` bytes each; null is empty."""
    if pa.types.is_string_view(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(what, dtype=np.uint8) if what is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ranges, one after another, and their offsets."""
    n = ends - starts
    return data[ranges(starts, n)], np.concatenate([[0], np.cumsum(n)])


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
