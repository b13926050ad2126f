"""Substring deduplication by super-k-mers.

A window is k consecutive words of one text. Each window has a minimiser: the least hash of its m-word grams. Consecutive
windows that share it form a super-k-mer, which travels as one packed string (its words, joined by a space) to the bucket
of the minimiser, where its windows are sorted by hash, compared word by word and so counted exactly. Equal windows have
equal minimisers, so a minimiser that the corpus has once holds no repeated window: those super-k-mers stay at home.

A run of over PIECE windows, as in periodic texts, is cut into pieces, so a packed string is so many words at most.

Skew: only repeated minimisers travel; their super-k-mers and bytes are pre-aggregated. A minimiser whose super-k-mers have more than
`hot` bytes isn't gathered in one bucket: equal super-k-mers (those of copies) are counted by partial aggregation, and each different one
is taken once, as a text of its own, through the same method with a second hash, so that its windows go, packed, to the buckets of
their second minimisers. A super-k-mer that comes several times is repeated as a whole. What is hot then too (windows that very many
different super-k-mers share) is counted window by window, by partial aggregation and an equi-join, whose skewed partitions Spark can
split. Nothing is dropped on any of these ways.

Nulls: a null text has no words; a null id is an id like others. Repeated rows (equal id and text) are separate rows, each of
them the "elsewhere" of the other. Empty texts and texts under k words keep all their words. Ties: windows are judged on the input, so no
copy is the one that stays. An empty table gives no rows. A very long text travels in pieces. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsieve.llm.common import KEY, Words, binary_array, cut, full_starts, gather, gram_hashes, mix, ranges, row_key, text_slices

HOT = 16 << 20
"""Bytes of super-k-mers of one minimiser that a bucket takes at most."""
PIECE = 1024
"""Windows of a super-k-mer at most."""
ROW = 64
"""Bytes that a super-k-mer counts for besides its words."""
SEEDS = (0, 0x5851F42D4C957F2D)
"""What sets the first and the second hash apart."""


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    if len(x) < w:
        return x[:0]
    size, span, least = len(x) - w + 1, 1, x
    while span * 2 <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[:size], least[w - span : w - span + size])


def super_kmers(words: Words, k: int, m: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all runs of windows with one minimiser: the text's number, first word in that text, windows, minimiser, and
    whether the run has the minimiser in several places (only then can it hold equal windows itself)."""
    w = k - m + 1
    grams = gram_hashes(words.hashes(), m)
    grams = mix(grams ^ np.uint64(seed)) if seed else grams
    least = sliding_min(grams, w)
    at = full_starts(words.ptr, k)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none.astype(bool)
    mini = least[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (mini[1:] != mini[:-1])
    first = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(place % PIECE == 0)
    doc = np.searchsorted(words.ptr, at[first], side="right") - 1
    n = np.diff(np.append(first, len(at)))
    left = np.argmax(grams[at[first][:, None] + np.arange(w)] == mini[first][:, None], axis=1)
    right = np.argmax(grams[(at[first] + n - 1)[:, None] + np.arange(w)[::-1]] == mini[first][:, None], axis=1)
    return doc, at[first] - words.ptr[doc], n, mini[first].view(np.int64), left != n - 1 + w - 1 - right


def _minimisers(k: int, m: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
            for i, j, data, offsets in text_slices(batch.column("text")):
                doc, first, n, mini, _ = super_kmers(Words(data, offsets), k, m, seed)
                if len(doc):
                    yield pa.RecordBatch.from_arrays([pa.array(k1[i:j][doc]), pa.array(k2[i:j][doc]), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(mini)], names=[*KEY, "first", "n", "mini"])

    return run


def _only_minimisers(k: int, m: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                words = Words(data, offsets)
                doc, first, n, mini, several = super_kmers(words, k, m, seed)
                a = words.ptr[doc] + first
                size = words.ends[a + n + k - 2] - words.starts[a] + ROW if len(a) else a
                mini, which = np.unique(mini, return_inverse=True)
                sums = [np.bincount(which, weights=x, minlength=len(mini)).astype(np.int64) for x in (1 + several, size)]
                yield pa.RecordBatch.from_arrays([pa.array(mini.astype(np.int64)), *map(pa.array, sums)], names=["mini", "n", "size"])

    return run


def _pack(k: int, windows: bool):
    """The super-k-mers at the given places as strings; with `windows`, each window on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
            at = batch.column("at")
            bounds, (first, n, mini) = np.asarray(at.offsets), (np.asarray(x) for x in at.flatten().flatten())
            bounds = bounds - bounds[0]
            for i, j, data, offsets in text_slices(batch.column("text")):
                words = Words(data, offsets)
                doc = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))
                f, c, b = (x[bounds[i] : bounds[j]] for x in (first, n, mini))
                if windows:
                    doc, b, f, c = np.repeat(doc, c), np.repeat(b, c), ranges(f, c), np.ones(int(c.sum()), dtype=np.int64)
                joined, to = gather(np.append(data, 0x20).astype(np.uint8), words.starts, words.ends + 1)
                joined[to[1:] - 1] = 0x20
                a = words.ptr[doc] + f
                for s in range(0, len(doc), 20_000):
                    p = slice(s, s + 20_000)
                    packed, where = gather(joined, to[a[p]], to[a[p] + c[p] + k - 1] - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(b[p]), pa.array(k1[i:j][doc[p]]), pa.array(k2[i:j][doc[p]]), pa.array(f[p].astype(np.int32)), binary_array(packed, where)], names=["mini", *KEY, "first", "packed"])

    return run


def repeated_windows(words: Words, k: int) -> np.ndarray:
    """For each word index at which a window begins (full_starts): whether the same words are a window elsewhere here.

    Sorted by hash; neighbours of equal hash are compared as bytes. `words` has a single space between words.
    """
    at = full_starts(words.ptr, k)
    h = gram_hashes(words.hashes(), k)[at]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twin = np.full(len(at), -1)
    twin[order[1:][same]] = order[:-1][same]
    out = np.zeros(len(at), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    pairs = np.flatnonzero(twin >= 0)
    if len(pairs):
        # runs of windows whose twins are a run too are compared at once
        j = twin[pairs]
        new = np.ones(len(pairs), dtype=bool)
        new[1:] = (at[pairs[1:]] != at[pairs[:-1]] + 1) | (at[j[1:]] != at[j[:-1]] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(pairs)) - 1
        text = words.data.tobytes()
        bad = False
        for a, b, c, d in zip(words.starts[at[pairs[first]]], words.ends[at[pairs[last]] + k - 1], words.starts[at[j[first]]], words.ends[at[j[last]] + k - 1], strict=True):
            if text[a:b] != text[c:d]:
                bad = True
                break
        if bad:  # two windows share a hash: count all by their bytes
            seen: dict[bytes, int] = {}
            own = [text[words.starts[x] : words.ends[x + k - 1]] for x in at]
            for x in own:
                seen[x] = seen.get(x, 0) + 1
            out = np.array([seen[x] > 1 for x in own])
    return out


def _count(k: int):
    def done(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        if not table.num_rows:
            return
        sizes, parts = [], []
        for x in table.column("packed").chunks:
            where = np.frombuffer(x.buffers()[1], dtype=np.int32)[x.offset : x.offset + len(x) + 1].astype(np.int64)
            sizes.append(np.diff(where))
            parts.append(np.frombuffer(x.buffers()[2], dtype=np.uint8)[where[0] : where[-1]])
        words = Words(np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]))
        at = full_starts(words.ptr, k)[repeated_windows(words, k)]
        if len(at):
            row = np.searchsorted(words.ptr, at, side="right") - 1
            new = np.ones(len(at), dtype=bool)
            new[1:] = at[1:] != at[:-1] + 1
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            row, k1, k2, base = row[first], *(table.column(c).to_numpy() for c in KEY), table.column("first").to_numpy()
            start = at[first] - words.ptr[row] + base[row]
            yield pa.RecordBatch.from_arrays([pa.array(k1[row]), pa.array(k2[row]), pa.array(start.astype(np.int32)), pa.array((start + at[last] - at[first] + k).astype(np.int32))], names=[*KEY, "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches come sorted by minimiser; a chunk ends where one does."""
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            while batch.num_rows:
                mini = batch.column("mini").to_numpy()
                changes = np.flatnonzero(mini[1:] != mini[:-1]) + 1
                held_key = held[-1].column("mini")[-1].as_py() if held else None
                if size > 4 << 20 and held and (len(changes) or mini[0] != held_key):
                    end = 0 if mini[0] != held_key else int(changes[0])
                    yield from done([*held, batch.slice(0, end)])
                    held, size, batch = [], 0, batch.slice(end)
                    continue
                held.append(batch)
                size += batch.nbytes
                break
        if held:
            yield from done(held)

    return run


def _cover(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at")
            n_words, n_removed, spans, kept = [], [], [], []
            for text, found in zip(batch.column("text"), at, strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                merged: list[list[int]] = []
                for s, e in sorted((x["start"], x["end"]) for x in found.as_py() or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([s, e])
                n_words.append(len(words))
                n_removed.append(sum(e - s for s, e in merged))
                spans.append([{"start": s, "end": e} for s, e in merged])
                for s, e in reversed(merged):
                    del words[s:e]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c not in ("text", "at", *KEY)), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "removed", "kept_text"])

    return run


def repeated_spans(texts: DataFrame, k: int, m: int, hot: int, level: int = 0) -> DataFrame:
    """(_k1, _k2, start, end): word ranges of the rows (_k1, _k2, text) whose windows also start anywhere else among the rows."""
    pair, seed = "_k1 long, _k2 long", SEEDS[level]
    repeated = texts.select("text").mapInArrow(_only_minimisers(k, m, seed), "mini long, n long, size long").groupBy("mini").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    repeated = cut(repeated.where("n > 1").select("mini", "size"))
    most = repeated.agg(F.max("size")).first()[0] or 0
    places = texts.mapInArrow(_minimisers(k, m, seed), f"{pair}, first int, n int, mini long").join(repeated, "mini")

    def packed(which: DataFrame, windows: bool) -> DataFrame:
        at = which.groupBy(*KEY).agg(F.collect_set(F.struct("first", "n", "mini")).alias("at"))
        return texts.join(at, KEY).mapInArrow(_pack(k, windows), f"mini long, {pair}, first int, packed binary")

    strings = packed(places.where(F.col("size") <= hot), False)
    found = strings.repartition("mini").sortWithinPartitions("mini").mapInArrow(_count(k), f"{pair}, start int, `end` int")
    if most <= hot:
        return found
    rest = places.where(F.col("size") > hot)
    if level + 1 < len(SEEDS):
        own = [F.xxhash64(F.lit(x), "packed").alias(x) for x in KEY]
        several = cut(packed(rest, False).select(F.struct(*KEY, "first").alias("at"), *own, "packed"))
        # one of each; the number of words of those that come several times is what is repeated of them
        single = cut(several.groupBy(*KEY, "packed").agg(F.count("*").alias("copies")).withColumn("text", F.col("packed").cast("string")))
        whole = single.where("copies > 1").select(*KEY, F.lit(0).alias("start"), F.size(F.split("text", " ")).alias("end"))
        inside = repeated_spans(single.select(*KEY, "text"), k, m, hot, level + 1)
        spans = whole.unionByName(inside)
        back = several.select("at", *KEY).join(spans, KEY).select("at.*", "start", "end")
        return found.unionByName(back.select(*KEY, (F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("end")).alias("end")))
    single = packed(rest, True).select(*KEY, "first", "packed")
    twice = single.groupBy("packed").agg(F.count("*").alias("c")).where("c > 1")
    return found.unionByName(single.join(twice, "packed").select(*KEY, F.col("first").alias("start"), (F.col("first") + k).alias("end")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 35, m: int = 8, hot: int = HOT) -> DataFrame:
    """Per row of docs: id_col, n_words, n_removed, removed (word ranges, end exclusive) and kept_text.

    A word goes if a window of k words covers it whose word sequence also starts anywhere else, in the same text or another.
    """
    keyed = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    found = repeated_spans(keyed, k, m, hot)
    spans = found.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("at"))
    kind = docs.schema[id_col].dataType.simpleString()
    # keyed has the same columns here as in packed(), so its rows are shuffled once for both joins
    out = keyed.join(spans, KEY, "left")
    return out.mapInArrow(_cover(k), f"id {kind}, n_words long, n_removed long, removed array<struct<start:int,`end`:int>>, kept_text string").withColumnRenamed("id", id_col)
