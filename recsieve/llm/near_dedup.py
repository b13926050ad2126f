"""Near-duplicate documents: MinHash signatures joined within a Hamming distance by a multi-index.

A text's set is its distinct shingles of five lower-cased words. Its signature is SYMBOLS values of b = 16 bits, one per
hash function. Signatures are split into CHUNKS chunks of four symbols. If two signatures differ in at most DISTANCE =
2 * CHUNKS - 1 symbols, some chunk has at most one error (pigeonhole), so leaving out each symbol of each chunk in turn
gives a key that both have: all pairs under the distance meet. Two texts of similarity 0.75 differ in 17 of 68 symbols on
average and in over 33 with a probability of about one in 100,000.

A bucket isn't expanded into its pairs. Each member is held against the first of its bucket (that of the least digest); pairs
within the distance are confirmed on the full sets; the links' components are found. Buckets whose other members are then still in
several components stay open. Texts with much in common that aren't similar (pages with one frame) fill large open buckets, so open
buckets first lose the members that nothing in them can be similar to. A shingle counts as shared if two components of open
buckets have it. A member with n shingles, s of them shared, and another with n' and s' share at most min(s, s'), so a
link needs 175 * min(s, s') >= 75 * (n + n'): which the least n' and the least n' - 7/3 s' of the bucket rule out for most.
What is left is compared on whole sets (64-bit shingle hashes), but for the bucket's largest component with itself. What
links two components there is a link as it is, at whatever signature distance, and no later step refuses it. So only links between
texts that links connect already are left out, and the pairs that leave a task are fewer than its members. Members out of the
largest component are cut into parts of PART members or ELEMENTS shingles, as are all members, and each pair of such parts is
a task: a task's memory has a bound however large a bucket is.

Texts with equal word sequences form one class, found by partial aggregation of a digest; only classes are compared.

Nulls: a null or wordless text has an empty set and no links. A null id can't be a component's id unless it is alone in it.
Repeated rows are copies of each other. Texts just at the threshold are linked. An empty table gives an empty one. A very long text is
one row, with its set of hashes in memory. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsieve.llm.common import KEY, Words, binary_array, constants, cut, full_starts, gather, gram_hashes, mix, ranges, row_key, text_slices
from recsieve.llm.components import connected_components

SHINGLE = 5
CHUNKS = 17
SYMBOLS = 4 * CHUNKS
DISTANCE = 2 * CHUNKS - 1
PERCENT = 75
PER_LEADER = 2000
"""Members that one task holds against one leader."""
BLOCK = 256
PART = 1000
"""Members of a bucket that a task takes from either side."""
ELEMENTS = 2_000_000
"""Shingles that they have in all, about; a longer text is a part of its own."""
SEND_BYTES = 8 << 20

_XOR = constants(SYMBOLS, 101)
_TIMES = constants(SYMBOLS, 202) | np.uint64(1)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, text by text, and their offsets. Texts of fewer words have one, those of none have none."""
    h = words.hashes()
    n = np.diff(words.ptr)
    offsets = np.concatenate([[0], np.cumsum(np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1)))])
    out = np.zeros(offsets[-1], dtype=np.uint64)
    short = np.zeros(len(out), dtype=bool)
    for k in range(1, SHINGLE):
        these = np.flatnonzero(n == k)
        if len(these):
            out[offsets[these]] = gram_hashes(h, k)[words.ptr[these]]
            short[offsets[these]] = True
    out[~short] = gram_hashes(h, SHINGLE)[full_starts(words.ptr, SHINGLE)]
    return out, offsets


def signatures(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """SYMBOLS 16-bit values per text that has shingles; zeros for others."""
    out = np.zeros((len(offsets) - 1, SYMBOLS), dtype=np.uint16)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        for j in range(SYMBOLS):
            out[full, j] = mix(np.minimum.reduceat((h ^ _XOR[j]) * _TIMES[j], offsets[full])) >> np.uint64(48)
    return out


def _distinct(h: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        x = np.sort(h[a:b])
        out.append(x[np.append(True, x[1:] != x[:-1])] if b > a else x)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in text_slices(batch.column("text")):
            words = Words(data, offsets, lower=True)
            h, to = shingles(words)
            joined, at = gather(np.append(words.data, 0x20).astype(np.uint8), words.starts, words.ends + 1)
            joined[at[1:] - 1] = 0x20
            text = joined.tobytes()
            same = [hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(at[words.ptr[:-1]], at[words.ptr[1:]])]
            n = [len(x) for x in _distinct(h, to)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(i, j - i) for c in ("id", *KEY)), pa.array(same, pa.binary()), pa.array(n, pa.int64()), binary_array(signatures(h, to).view(np.uint8).ravel(), np.arange(j - i + 1) * 2 * SYMBOLS)],
                names=["id", *KEY, "same", "n", "sig"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four keys for each chunk: its number, the symbol left out and the other three, in 55 bits."""
    for batch in batches:
        sig = _matrix(batch.column("sig")).astype(np.int64)
        keys = []
        for chunk in range(CHUNKS):
            for out in range(4):
                key = np.full(len(sig), chunk * 4 + out, dtype=np.int64)
                for x in range(4):
                    if x != out:
                        key = (key << 16) | sig[:, chunk * 4 + x]
                keys.append(key)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.tile(batch.column("c").to_numpy(), len(keys)))], names=["key", "c"])


TASK = ["key", "low", "high"]
PLACE = ["key", "c", "root", "own", "of", "parts_own", "parts_of"]
"""Where a class goes in an open bucket: its part among those out of the largest component (-1: it is in that), its part among all, and
how many parts of either kind there are."""


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.count_nonzero(_matrix(batch.column("sig_a")) != _matrix(batch.column("sig_b")), axis=1) <= DISTANCE
        yield pa.RecordBatch.from_arrays([pa.array(batch.column(x).to_numpy()[keep]) for x in ("a", "b")], names=["a", "b"])


def _tasks(own: np.ndarray, of: np.ndarray, parts_own: np.ndarray, parts_of: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, low, high, left, right) of all tasks that places go to: a part of those out of the largest component, a part of all, and
    on which sides of that task a place is."""
    n = np.where(own < 0, parts_own, parts_of + parts_own - 1)
    at = np.repeat(np.arange(len(n)), n)
    k = ranges(np.zeros(len(n), dtype=np.int64), n)
    more = k - parts_of[at]
    row = (own[at] >= 0) & (more < 0)  # on the left, against each part of all
    low = np.where(row, own[at], np.where(own[at] < 0, k, more + (more >= own[at])))
    high = np.where(row, k, of[at])
    return at, low, high, low == own[at], high == of[at]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text's set of shingle hashes, sorted, once for each task that it goes to."""
    for batch in batches:
        to = batch.column("to")
        bounds = np.asarray(to.offsets) - np.asarray(to.offsets)[0]
        field = dict(zip(PLACE, (np.asarray(x).astype(np.int64) for x in to.flatten().flatten())))
        for i, j, data, offsets in text_slices(batch.column("text")):
            own = [x.tobytes() for x in _distinct(*shingles(Words(data, offsets, lower=True)))]
            first, end = bounds[i], bounds[j]
            at, low, high, left, right = _tasks(*(field[x][first:end] for x in PLACE[3:]))
            text = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))[at]
            sent = np.cumsum(np.array([len(x) for x in own])[text]) // SEND_BYTES  # some bytes at once: a text may go to many
            edges = [0, *(np.flatnonzero(np.diff(sent)) + 1), len(text)]
            for a, b in zip(edges, edges[1:]):
                some = slice(a, b)
                there = [field[x][first:end][at[some]] for x in ("key", "c", "root")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(there[0]), pa.array(low[some]), pa.array(high[some]), pa.array(left[some]), pa.array(right[some]), pa.array(there[1]), pa.array(there[2]), pa.array([own[t] for t in text[some]], pa.binary())],
                    names=[*TASK, "left", "right", "c", "root", "set"],
                )


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each class's distinct shingles."""
    for batch in batches:
        c, root = (batch.column(x).to_numpy() for x in ("c", "root"))
        for i, j, data, offsets in text_slices(batch.column("text")):
            own = _distinct(*shingles(Words(data, offsets, lower=True)))
            n = [len(x) for x in own]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view(np.int64)), pa.array(np.repeat(c[i:j], n)), pa.array(np.repeat(root[i:j], n))], names=["h", "c", "root"])


def _shared(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many elements each of x shares with each of y; the sets are sorted. Ranges of hashes one by one: memory has a bound."""
    ranges = 1 + sum(map(len, (*x, *y))) // ELEMENTS
    if ranges == 1:
        return _shared_range(x, y)
    total = np.zeros((len(x), len(y)), dtype=np.int64)
    edges = [np.uint64((i << 64) // ranges) for i in range(ranges)]
    at = [[*np.searchsorted(s, edges), len(s)] for s in (*x, *y)]
    for r in range(ranges):
        part = [s[a[r] : a[r + 1]] for s, a in zip((*x, *y), at)]
        total += _shared_range(part[: len(x)], part[len(x) :])
    return total


def _shared_range(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """A matrix product, some columns at once; each is a hash that several sets have."""
    values, where = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    rows = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in (*x, *y)])
    several = np.bincount(where, minlength=len(values)) > 1
    column = np.cumsum(several) - 1
    keep = several[where]
    where, rows = column[where[keep]], rows[keep]
    order = np.argsort(where, kind="stable")
    where, rows = where[order], rows[order]
    total = np.zeros((len(x), len(y)), dtype=np.int64)
    for first in range(0, int(several.sum()), 4096):
        a, b = np.searchsorted(where, [first, first + 4096])
        m = np.zeros((len(x) + len(y), 4096), dtype=np.float32)
        m[rows[a:b], where[a:b] - first] = 1
        total += (m[: len(x)] @ m[len(x) :].T).astype(np.int64)
    return total


def _join_bucket(c: np.ndarray, root: np.ndarray, sets: list[np.ndarray], left: slice | None = None, right: slice | None = None) -> tuple[list[int], list[int]]:
    """Links that connect all members which similar pairs of one of `left` and one of `right` (all, if not given) across components
    connect; no others are needed.

    The sets are whole, so what is given here is a link: nothing later refuses it, and what it connects stays connected.
    """
    parent: dict[int, int] = {int(r): int(r) for r in root}

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    n = np.array([len(s) for s in sets])
    out: tuple[list[int], list[int]] = ([], [])
    left, right = left or slice(0, len(c)), right or slice(0, len(c))
    for i in range(left.start, left.stop, BLOCK):
        for j in range(right.start, right.stop, BLOCK):
            p, q = slice(i, min(i + BLOCK, left.stop)), slice(j, min(j + BLOCK, right.stop))
            if q.stop <= left.stop and q.start >= right.start and q.stop <= p.start and p.start >= right.start:
                continue  # both blocks are on both sides: they met the other way round
            across = np.array([find(int(r)) for r in root[p]])[:, None] != np.array([find(int(r)) for r in root[q]])[None, :]
            if not across.any():
                continue
            both = _shared(sets[p], sets[q])
            similar = 100 * both >= PERCENT * (n[p][:, None] + n[q][None, :] - both)
            for x, y in zip(*np.nonzero(across & similar)):
                a, b = find(int(root[i + x])), find(int(root[j + y]))
                if a != b:
                    out[0].append(int(min(c[i + x], c[j + y])))
                    out[1].append(int(max(c[i + x], c[j + y])))
                    parent[a] = b
    return out


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task: what links a task's two parts across components."""
    held: list[pa.RecordBatch] = []

    def task(batch: pa.RecordBatch, row: int) -> tuple[int, ...]:
        return tuple(batch.column(x)[row].as_py() for x in TASK)

    def done() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        held.clear()
        c, first = np.unique(t.column("c").to_numpy(), return_index=True)
        root, left, right = (t.column(x).to_numpy()[first] for x in ("root", "left", "right"))
        order = np.argsort(np.where(left & right, 1, np.where(left, 0, 2)), kind="stable")  # left, both, right
        packed = t.column("set").take(pa.array(first[order])).to_pylist()
        only_left = int(np.count_nonzero(left & ~right))
        a, b = _join_bucket(c[order], root[order], [np.frombuffer(x, dtype=np.uint64) for x in packed], slice(0, int(left.sum())), slice(only_left, len(c)))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        of = np.stack([batch.column(x).to_numpy() for x in TASK])
        bounds = [0, *(np.flatnonzero((of[:, 1:] != of[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            if b > a:
                if held and task(held[-1], 0) != tuple(of[:, a]):
                    yield from done()
                held.append(batch.slice(a, b - a))
    if held:
        yield from done()


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by leader, its own text first: members whose full sets are similar enough to the leader's."""
    leader, own = None, np.zeros(0, dtype=np.uint64)
    for batch in batches:
        a, salt, role, c = (batch.column(x).to_numpy() for x in ("a", "salt", "role", "c"))
        found: list[int] = []
        for i, j, data, offsets in text_slices(batch.column("text")):
            for r, x in zip(range(i, j), _distinct(*shingles(Words(data, offsets, lower=True)))):
                if role[r] == 0:
                    leader, own = (a[r], salt[r]), x
                elif leader == (a[r], salt[r]) and len(own) and len(x):
                    where = np.minimum(np.searchsorted(own, x), len(own) - 1)
                    both = int(np.count_nonzero(own[where] == x))
                    if 100 * both >= PERCENT * (len(own) + len(x) - both):
                        found.append(r)
        yield pa.RecordBatch.from_arrays([pa.array(a[found]), pa.array(c[found])], names=["a", "b"])


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose signatures are near and whose full sets are similar. A text travels once per leader."""
    sig = classes.select("c", "sig")
    near = cut(
        pairs.distinct()
        .join(sig.select(F.col("c").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(sig.select(F.col("c").alias("b"), F.col("sig").alias("sig_b")), "b")
        .select("a", "b", "sig_a", "sig_b").mapInArrow(_near, "a long, b long")
    )
    parts = near.groupBy("a").agg(F.ceil(F.count("*") / PER_LEADER).cast("int").alias("parts"))
    salted = near.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"), "b")
    wanted = salted.select("a", "salt", F.lit(1).alias("role"), F.col("b").alias("c")).unionByName(salted.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("c")).distinct())
    to = wanted.join(classes.select("c", *KEY), "c").groupBy(*KEY).agg(F.collect_set(F.struct("a", "salt", "role", "c")).alias("to"))
    sent = texts.join(to, KEY).select("text", F.explode("to").alias("to")).select("to.*", "text")
    return sent.repartition("a", "salt").sortWithinPartitions("a", "salt", "role").mapInArrow(_confirm, "a long, b long")


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(same, component_id): per class the least id of its component. Only linked classes meet by component."""
    linked = connected_components(links).withColumnRenamed("node", "c").join(classes.select("c", "least"), "c")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("c", F.lit(True).alias("linked"), "component_id")
    return classes.select("c", "same", "least").join(named, "c", "left").select("same", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))


def _numbered(classes: DataFrame) -> DataFrame:
    """classes with c, a digest of their words: the same in every run. Classes whose digests agree (by chance, among billions) get others."""
    named, seed = cut(classes.withColumn("c", F.xxhash64("same"))), 0
    while not (twice := cut(named.groupBy("c").agg(F.count("*").alias("_n")).where("_n > 1"))).isEmpty():
        seed += 1
        named = cut(named.join(twice, "c", "left").withColumn("c", F.when(F.col("_n") > 1, F.xxhash64(F.lit(seed), "same")).otherwise(F.col("c"))).drop("_n"))
    return named


def _bounded(member: DataFrame) -> DataFrame:
    """The members (key, c, n, shared) of open buckets that some member's n and shared leave a similarity of PERCENT with."""
    low, high = F.lit(PERCENT), F.lit(100 + PERCENT)  # high * min(s, s') >= low * (n + n')
    bounds = member.groupBy("key").agg(F.min(low * F.col("n") - high * F.col("shared")).alias("_least"), F.min("n").alias("_n"))
    return member.join(bounds, "key").where((F.col("_least") <= -low * F.col("n")) & (low * (F.col("_n") + F.col("n")) <= high * F.col("shared"))).drop("_least", "_n")


def _open_places(stars: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame, part_members: int) -> DataFrame:
    """PLACE: where the members of open buckets go that may still be linked there with another component."""
    roots = classes.select("c", "n").join(found.withColumnRenamed("node", "c"), "c", "left").select("c", F.coalesce("root", "c").alias("root"), "n")
    member = stars.select("key", F.col("b").alias("c")).join(roots, "c")
    # the first of a bucket was held against all others: what is left are the others, if in several components;
    # of buckets with the same members, one is enough
    grouped = member.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("size"), F.sum(F.xxhash64("c").cast("decimal(38,0)")).alias("members"))
    open_keys = grouped.where("x < y").groupBy("size", "members").agg(F.min("key").alias("key")).select("key")
    member = cut(member.join(open_keys, "key"))
    who = member.select("c", "root").distinct().join(classes.select("c", *KEY), "c")
    rows = cut(texts.join(who, KEY).select("text", "c", "root").mapInArrow(_shingle_rows, "h long, c long, root long"))
    several = rows.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("h")
    shared = rows.join(several, "h").groupBy("c").agg(F.count("*").alias("shared"))
    member = cut(_bounded(_bounded(member.join(shared, "c"))))
    # the largest component of a bucket isn't held against itself
    sizes = member.groupBy("key", "root").agg(F.count("*").alias("size"), F.sum("n").alias("elements"))
    total = sizes.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("largest"), F.max("size").alias("most"), F.sum("size").alias("size"), F.max_by("elements", F.struct("size", "root")).alias("own"), F.sum("elements").alias("elements"))
    parts = lambda size, elements: F.greatest(F.ceil(size / part_members), F.ceil(elements / ELEMENTS)).cast("int")
    total = total.where("most < size").select("key", "largest", parts(F.col("size") - F.col("most"), F.col("elements") - F.col("own")).alias("parts_own"), parts(F.col("size"), F.col("elements")).alias("parts_of"))
    part = lambda n: F.pmod(F.xxhash64("c"), F.col(n)).cast("int")
    own = F.when(F.col("root") == F.col("largest"), -1).otherwise(part("parts_own"))
    return member.join(total, "key").select("key", "c", "root", own.alias("own"), part("parts_of").alias("of"), "parts_own", "parts_of")


def _stars(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, classes, texts, stars): signed rows, classes of equal word sequences, texts by row key, and (key, a, b), a being the first of a bucket."""
    keyed = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = cut(keyed.mapInArrow(_sign, f"id {kind}, _k1 long, _k2 long, same binary, n long, sig binary"))
    classes = rows.where("n > 0").groupBy("same").agg(F.min(F.struct("_k1", "_k2", "n", "sig")).alias("x"), F.min("id").alias("least"))
    classes = _numbered(classes.select("same", "least", "x.*"))
    keys = classes.select("c", "sig").mapInArrow(_keys, "key long, c long")
    # the first of a bucket is a minimum, summed up by task before it travels, and the bucket's join is one that Spark can split
    first = keys.groupBy("key").agg(F.min("c").alias("a"), F.count("*").alias("size")).where("size > 1").select("key", "a")
    return rows, classes, keyed.select(*KEY, "text"), cut(keys.join(first, "key").where("c <> a").select("key", "a", F.col("c").alias("b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_members: int = PART) -> DataFrame:
    """Per row of docs: id_col, _k1, _k2 (its row_key), n_shingles, component_id, kept."""
    rows, classes, texts, stars = _stars(docs, id_col, text_col)
    links = cut(_links(stars.select("a", "b"), classes, texts))
    found = cut(connected_components(links))
    places = _open_places(stars, found, classes, texts, part_members)
    # a class has as many places as keys, 68 at most; the tasks they stand for are made where its text is
    to = places.join(classes.select("c", *KEY), "c").groupBy(*KEY).agg(F.collect_set(F.struct(*(F.col(x).cast("long").alias(x) for x in PLACE))).alias("to"))
    sets = texts.join(to, KEY).select("text", "to").mapInArrow(_sets, "key long, low long, high long, left boolean, right boolean, c long, root long, set binary")
    across = sets.repartition(*TASK).sortWithinPartitions(*TASK).mapInArrow(_across, "a long, b long")

    named = _components(classes, found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(across))
    out = rows.select("id", *KEY, "n", "same").join(named.withColumn("classed", F.lit(True)), "same", "left")
    out = out.withColumn("component_id", F.when(F.col("classed"), F.col("component_id")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), *KEY, F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group: that of the least id (of rows equal in id and text, one)."""
    found = near_duplicates(docs, id_col, text_col).where("kept")
    linked = found.groupBy("component_id", F.when(F.col("n_shingles") == 0, F.struct(*KEY)).alias("alone")).agg(F.min(F.struct(*KEY)).alias("x")).select("x.*")
    names = docs.columns
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), *row_key(id_col, text_col))
    return keyed.join(linked, KEY).dropDuplicates(KEY).select("row.*")
