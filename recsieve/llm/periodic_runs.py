"""Periodic runs of words within texts: maximal stretches that repeat with a period, and texts with the repeats taken out.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least max(shortest, times * q) words,
which no neighbouring word extends with the same period. Most texts have none, so most words are masked first. A run of length L
and period q holds its first L - q words again q words on, and each stretch of k of its words begins again q words before or after
it, k being the least overlap that any period leaves: min over q of max(shortest, times * q) - q. So all words of a run lie in k-grams
that the text has twice. Words outside such k-grams (told apart by hashes, of which equal ones can only keep words that could go)
part what survives into segments, and no run leaves its segment.

The segments of a slice of texts, with borders between them, go through Main and Lorentz's division together, a level at a time: a
run crosses the middle of the smallest block that holds it, and on one side at least it has a period there. So for each middle and
each period, the words there and a period away are compared forward and backward; both directions together give the run. Comparisons
use ranks of stretches of 1, 2, 4, ... words found by prefix doubling, exact ones, so that how far two places agree takes a
logarithm of steps; most pairs fall by one look at the ranks of the stretch that they would have to share at least.

Rows are independent: nothing is shuffled, and a task holds a slice of texts, or one text, at once: n log n in its words.

Words are `[^\\x20\\x09-\\x0D]+`. Nulls: a null or wordless text has no words and no runs, and collapses to the empty text; a null id is
an id like others. Ties: runs of equal places don't exist (the smallest period alone counts); runs are ordered by start, then period.
Repeated rows get equal results. An empty table gives an empty one. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsieve.llm.common import Words, full_starts, gather, gram_hashes, mix, ranges, text_slices

SHORTEST, TIMES = 6, 4
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def least_overlap(shortest: int, times: int) -> int:
    """How many words a run shares with itself one period on, at least."""
    return min(max(shortest, times * q) - q for q in range(1, shortest + 1))


def survivors(words: Words, h: np.ndarray, k: int) -> np.ndarray:
    """Which words lie in a k-gram that their text has twice or more."""
    at = full_starts(words.ptr, k)
    step = np.zeros(len(h) + 1, dtype=np.int64)
    if len(at):
        own = mix(gram_hashes(h, k)[at] ^ mix(words.doc_of()[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        again = np.zeros(len(at), dtype=bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        step = np.bincount(at[again], minlength=len(h) + 1) - np.bincount(at[again] + k, minlength=len(h) + 1)
    return np.cumsum(step)[:-1] > 0


def segments(words: Words, alive: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of surviving words of one text begin and end; too short ones are left out."""
    first = np.zeros(len(alive) + 1, dtype=bool)
    first[words.ptr] = True
    before = np.append(False, alive[:-1])
    after = np.append(alive[1:], False)
    starts = np.flatnonzero(alive & (~before | first[:-1]))
    ends = np.flatnonzero(alive & (~after | first[1:])) + 1
    keep = ends - starts >= least
    return starts[keep], ends[keep]


def doubled(x: np.ndarray, most: int) -> list[np.ndarray]:
    """ranks[j][i]: equal for places whose 2**j elements from there on are equal, up to stretches of `most`; places near the end have none."""
    out = [x]
    while 2 << (len(out) - 1) <= most:
        r, half = out[-1], 1 << (len(out) - 1)
        n = len(x) - 2 * half + 1
        if n <= 0:
            break
        key = r[:n].astype(np.int64) * (int(r.max()) + 1) + r[half : half + n]
        out.append(np.unique(key, return_inverse=True)[1].astype(np.int32))
    return out


def _agree(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many elements from a and b (b further on) agree, counted on from both, or back from before both."""
    n = np.zeros(len(a), dtype=np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        size = 1 << j
        i, k = (a + n, b + n) if forward else (a - n - size, b - n - size)
        there = (i >= 0) & (k < len(ranks[j]))
        n[there] += size * (ranks[j][i[there]] == ranks[j][k[there]])
    return n


def runs_of(x: np.ndarray, of: np.ndarray, shortest: int, times: int) -> np.ndarray:
    """(start, end, period) of all runs of x, in order. x holds segments, parted by elements that nothing else equals; `of` has the
    length of each element's segment."""
    found = []
    longest = int(of.max(initial=0))
    ranks = doubled(x, longest)
    half = 1
    while 2 * half < shortest:
        half *= 2
    while half < len(x):
        middle = np.arange(half, len(x), 2 * half)
        periods = np.minimum(2 * half, of[middle]) // times
        m, q = np.repeat(middle, periods), ranges(np.ones(len(middle), dtype=np.int64), periods)
        # a run of `length` words agrees with itself on length - q of them, half of which at least lie on one side of the place
        share = (np.maximum(shortest, times * q) - q + 1) // 2
        level = np.minimum(np.log2(share).astype(np.int64), len(ranks) - 1)
        for a, b in ((m, m + q), (m - q, m)):
            near = np.zeros(len(m), dtype=bool)
            for j in np.unique(level):
                r, these = ranks[j], np.flatnonzero(level == j)
                for shift in (0, -(1 << j)):
                    i, k = a[these] + shift, b[these] + shift
                    there = (i >= 0) & (k < len(r))
                    near[these[there]] |= r[i[there]] == r[k[there]]
            a, b, p = a[near], b[near], q[near]
            start, end = a - _agree(ranks, a, b, False), b + _agree(ranks, a, b, True)
            keep = end - start >= np.maximum(shortest, times * p)
            found.append(np.stack([start[keep], end[keep], p[keep]], axis=1))
        half *= 2
    every = np.concatenate([*found, np.zeros((0, 3), dtype=np.int64)])
    # several periods of one stretch are multiples of its smallest one
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), dtype=bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[new]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def text_runs(words: Words, shortest: int, times: int) -> np.ndarray:
    """(start, end, period) of all runs of all texts, by word numbers of the slice, in order."""
    starts, ends = segments(words, survivors(words, words.hashes(), least_overlap(shortest, times)), shortest)
    if not len(starts):
        return np.zeros((0, 3), dtype=np.int64)
    n = ends - starts
    at = ranges(starts, n + 1)  # each segment and a border
    border = np.cumsum(n + 1) - 1
    raw, ids = words.data.tobytes(), {}
    x = np.fromiter((ids.setdefault(raw[s:e], len(ids)) for s, e in zip(words.starts[np.delete(at, border)], words.ends[np.delete(at, border)])), dtype=np.int32)
    whole = np.empty(len(at), dtype=np.int32)
    inside = np.ones(len(at), dtype=bool)
    inside[border] = False
    whole[inside], whole[border] = x, len(ids) + np.arange(len(border))
    of = np.repeat(n, n + 1)
    of[border] = 0
    found = runs_of(whole, of, shortest, times)
    found[:, :2] += (at[found[:, 0]] - found[:, 0])[:, None]
    return found


def _collapse(words: Words, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each text, joined by spaces, and their offsets; what is gone is every run but its first period."""
    size = len(words.starts) + 1
    step = np.bincount(found[:, 0] + found[:, 2], minlength=size) - np.bincount(found[:, 1], minlength=size)
    kept = np.flatnonzero(np.cumsum(step)[:-1] == 0)
    data, ends = gather(np.append(words.data, 0x20).astype(np.uint8), words.starts[kept], words.ends[kept] + 1)
    data[ends[1:] - 1] = 0x20
    first = np.searchsorted(kept, words.ptr)
    last = np.zeros(len(data), dtype=bool)  # no space after a text's last word
    last[ends[first[1:][first[1:] > first[:-1]]] - 1] = True
    return data[~last], np.concatenate([[0], np.cumsum(~last)])[ends[first]]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """Per row of docs: id_col, n_words, runs (start, length, period in words, by start, then period) and collapsed_text: the words that
    are in no run but in its first period, joined by one space. `shortest` is 2 at least, and `times` 2."""
    if shortest < 2 or times < 2:
        raise ValueError("a run has two periods and two words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                words = Words(data, offsets)
                found = text_runs(words, shortest, times)
                bounds = np.searchsorted(found[:, 0], words.ptr)
                start = found[:, 0] - words.ptr[np.searchsorted(words.ptr, found[:, 0], side="right") - 1]
                rows = pa.StructArray.from_arrays([pa.array(start), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], fields=list(RUN_TYPE.value_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, j - i), pa.array(np.diff(words.ptr)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows), _strings(*_collapse(words, found))], names=["id", "n_words", "runs", "collapsed_text"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string")
    return out.withColumnRenamed("id", id_col)
