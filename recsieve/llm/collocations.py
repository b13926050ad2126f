"""Phrases whose words stand together more often than apart, by language.

Texts are lower-cased (A-Z), split at `[.,;:!?\\x0A-\\x0D]` into pieces, and those into words `[^\\x20\\x09]+`. A task takes texts by shards of
about SHARD_BYTES. Words of a shard get ids; ranks of the stretches of 2 and of 4 words from each place follow by prefix doubling, and
the places in order of their first five words are the shard's suffix array, cut at that depth. Places in a row that share k words or
more are an interval: its size is how often the shard has that phrase of k words.

Shards' counts are added up in three passes. A phrase's key is a 64-bit hash. The first pass adds up all phrases of one to SHORT words by key. A phrase
that comes `least` times consists of such that do: those go out as a bitmap of a fixed size (16 MB; `bits`, a power of two of 32,768 at
least) however large the corpus is, and keys that share a bit can only keep phrases that could go. The second pass parts texts where a pair isn't
frequent, ends phrases where a triple isn't, and adds up the longer phrases, which a task joins by key before it sends them.

The third pass names the frequent keys. Counts carry a tag: the least class (16 bits of a hash) of a text that has the phrase. Just texts of that
class send the phrase itself, so it travels about once and not from every shard; which class names which key goes out as bits of a fixed size too (PROBES bits for each key).
Keys don't decide alone. A tag also has a check, 16 bits of another hash (of words' lengths and sums of bytes too), and the third pass holds every occurrence of a frequent key
against its key's check. Keys with a phrase that fails it stand for more than one; all their phrases are counted again by their text. So a wrong
count needs two phrases, one of them frequent, that share a key and a check, or a key and the bits that the bitmap of checks has by chance. A task holds one shard's words and one sort of them; what it looks up is made by pieces.

A candidate is a phrase of 2 to `longest` words with a = f(phrase) >= least. Its parts have counts of their own in the same table, as
they come at least as often. Arithmetic is in decimals of 38 digits. The first `top` of each language are found within parts
of a language first, so no task sorts a whole one.

Nulls: a null text is empty; a null language is `und`, as that word itself is. Ties: cuts of equal score go to the shortest first
part, rows of equal score to the larger count, then to the lesser phrase (UTF-8 byte order). Repeated rows count as often as they
come. An empty table, and languages without candidates, give no rows. A very long text is a shard of its own. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsieve.llm.common import Words, cut, gather, mix, ranges, text_slices

SHARD_BYTES = 2 << 20
NAMED_BYTES = 1 << 20
"""A shard's bytes where phrases are named, beside three bitmaps: nothing is added up there."""
BUCKET = 1 << 15
"""Bits of one of Spark's bitmaps."""
BITS = 4096 * BUCKET
PROBES = 4
"""Bits for each key where a bitmap is to let few others through."""
SHORT = 3
"""Words of the phrases that are counted without a bitmap."""
HELD = 1 << 17
"""Counts that a task holds to join them by key."""
BATCH = 1 << 16
"""Rows that a task gives to Spark at once, and words that it looks up at once."""
TEXTS = 1 << 14
"""Phrases whose texts are made at once."""
PART_BYTES = 1 << 19
"""Bytes of texts that are parted into words at once."""
LEAST, LONGEST, TOP = 100, 5, 2000
BROADCAST_BYTES = 1 << 20
PARTS = 64
"""Parts of a language that are ranked on their own first."""

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[[0x20, 0x09]] = True


@dataclass
class Shard:
    """The words of some texts: byte ranges, languages, hashes that differ by language, sums of bytes, classes of texts, and which words follow which in one piece.

    A byte follows each word.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    lang: np.ndarray
    hash: np.ndarray
    sums: np.ndarray
    text: np.ndarray
    follows: np.ndarray

    def pair_hashes(self) -> np.ndarray:
        """For each word but the last, a hash of it and the next one."""
        return _and_next(self.hash[:-1], self.hash[1:])

    def triple_hashes(self) -> np.ndarray:
        """For each word but the last two, a hash of it and the next two."""
        return _and_next(self.pair_hashes()[:-1], self.hash[2:])

    def keys(self, place: np.ndarray, k: int) -> np.ndarray:
        """Of the k words from each place on: their hash, whose first bit says whether they are more than SHORT."""
        x = self.hash[place]
        for j in range(1, k):
            x = mix(x * _AND ^ self.hash[place + j])
        return _key(x, k)

    def checks(self, place: np.ndarray, k: int) -> np.ndarray:
        """Of the k words from each place on: 16 bits of another hash."""
        x = np.zeros(len(place), dtype=np.uint64)
        for j in range(k):
            x = mix(x * _CHECK ^ self.hash[place + j] + self.sums[place + j])
        return x >> np.uint64(48)

    def tags(self, place: np.ndarray, k: int) -> np.ndarray:
        """Of the k words from each place on: their text's class, then their check."""
        return self.text[place].astype(np.uint64) << np.uint64(16) | self.checks(place, k)

    def left(self) -> np.ndarray:
        """How many words there are from each word to its piece's end."""
        last = np.append(~self.follows[1:], True)
        here = np.arange(len(last), dtype=np.int32)
        ends = np.where(last, here, np.int32(len(last)))
        return np.minimum.accumulate(ends[::-1])[::-1] - here + np.int32(1)


_AND, _CHECK, _CLASS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_KEY = np.uint64((1 << 63) - 1)


def _key(x: np.ndarray, k: int) -> np.ndarray:
    return x & _KEY | np.uint64((k > SHORT) << 63)


def _pieces(n: int) -> Iterator[slice]:
    for i in range(0, n, BATCH):
        yield slice(i, i + BATCH)


def _and_next(x: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hashes of what x and following stand for, one after the other."""
    out = np.empty(len(following), dtype=np.uint64)
    for at in _pieces(len(out)):
        out[at] = mix(x[at] * _AND ^ following[at])
    return out


def _slice(data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, of_lang: np.ndarray) -> Shard:
    """A slice's words; its texts have the languages `lang`, whose hashes are `of_lang`."""
    words = Words(data, offsets, lower=True, between=_BETWEEN)
    lang = np.repeat(lang, np.diff(words.ptr))
    piece = np.cumsum(_BREAK[data], dtype=np.int32)[words.starts]
    follows = np.zeros(len(words.starts), dtype=bool)  # the word before is in the same piece
    follows[1:] = piece[1:] == piece[:-1]
    follows[words.ptr[:-1][words.ptr[:-1] < len(piece)]] = False
    hashes = words.hashes()
    upto = np.append(np.uint64(0), np.cumsum(hashes))[words.ptr]
    text = np.repeat((mix(upto[1:] - upto[:-1]) >> np.uint64(48)).astype(np.uint16), np.diff(words.ptr))
    upto = np.append(np.uint32(0), np.cumsum(words.data, dtype=np.uint32))
    sums = (upto[words.ends] - upto[words.starts] + np.uint32(257) * (words.ends - words.starts).astype(np.uint32)).astype(np.uint16)
    return Shard(words.data, words.starts.astype(np.int32), words.ends.astype(np.int32), lang.astype(np.int32), mix(hashes ^ of_lang[lang]), sums, text, follows)


def _in_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of x by value, then place; and which of them are the first with their value."""
    order = np.argsort(x, kind="stable").astype(np.int32)
    fresh = np.ones(len(x), dtype=bool)
    for at in _pieces(len(x) - 1):
        fresh[1:][at] = x[order[1:][at]] != x[order[:-1][at]]
    return order, fresh


def _sizes(first: np.ndarray, n: int) -> np.ndarray:
    """How far it is from each of `first` to the next, and to n."""
    return np.diff(np.append(first, n))


def _ranks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element, how many distinct values of x are less; and the places of x by value, then place."""
    order, fresh = _in_order(x)
    out = np.empty(len(x), dtype=np.int32)
    out[order] = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
    return out, order


def intervals(x: np.ndarray, left: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For k = 1 to `longest`: k, a place of each phrase of k elements, and how often x has it. `left`: elements from a place to its piece's end."""
    n = len(x)
    one, order = _ranks(x)
    ranks, k = {1: one}, 1
    del x
    while k < longest:
        del order
        more = min(k, 1 << (longest - k).bit_length() - 1)
        key = ranks[k].astype(np.int64)
        key *= int(ranks[more].max(initial=0)) + 2
        following = ranks[more][k:] + np.int32(1)
        following[left[: len(following)] <= k] = 0  # the piece ends before
        key[: len(following)] += following
        k += more
        ranks = {j: r for j, r in ranks.items() if j <= longest - k}
        ranks[k], order = _ranks(key)  # at last the suffix array, by the first `longest` elements
        del key, following
    del ranks
    shared = np.zeros(max(n - 1, 0), dtype=np.int8)  # how many elements neighbours share, up to `longest`
    for at in _pieces(n - 1):
        a, b = order[:-1][at], order[1:][at]
        same = np.ones(len(a), dtype=bool)
        for k in range(1, longest + 1):
            i, j = np.minimum(a + k - 1, n - 1), np.minimum(b + k - 1, n - 1)
            same &= (left[a] >= k) & (left[b] >= k) & (one[i] == one[j])
            shared[at][same] = k
    for k in range(1, longest + 1):
        first = np.flatnonzero(np.append(True, shared < k)[:n])
        there = left[order[first]] >= k
        yield k, order[first[there]], _sizes(first, n)[there]


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[tuple[Shard, list[str]]]:
    """Shards and the languages' names, by number."""
    held: list[Shard] = []
    numbers: dict[str, int] = {}
    hashes = np.zeros(0, dtype=np.uint64)
    size = 0

    def done() -> tuple[Shard, list[str]]:
        shift = np.cumsum([0, *(len(x.data) for x in held)]).astype(np.int32)
        for x, s in zip(held, shift):
            x.starts += s
            x.ends += s
        parts = {f.name: [getattr(x, f.name) for x in held] for f in fields(Shard)}
        held.clear()
        parts["data"].append(np.full(1, 0x20, dtype=np.uint8))
        return Shard(**{name: np.concatenate(parts.pop(name)) for name in list(parts)}), list(numbers)

    for batch in batches:
        named = batch.column("lang").cast(pa.string()).fill_null("und").dictionary_encode()
        names = named.dictionary.to_pylist()
        for name in names:
            if numbers.setdefault(name, len(numbers)) == len(hashes):
                hashes = np.append(hashes, np.frombuffer(hashlib.blake2b(name.encode(), digest_size=8).digest(), dtype=np.uint64))
        lang = np.array([numbers[x] for x in names], dtype=np.int64)[named.indices.to_numpy()] if len(named) else np.zeros(0, dtype=np.int64)
        for i, j, data, offsets in text_slices(batch.column("text"), min(PART_BYTES, shard_bytes)):
            if held and size + len(data) > shard_bytes:
                yield done()
                size = 0
            held.append(_slice(data, offsets, lang[i:j], hashes))
            size += len(data)
    if held:
        yield done()


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """Rows key, tag, count of all parts as one for each key: the least tag, all counts."""
    key, tag, n = np.concatenate(parts, axis=1)
    order, fresh = _in_order(key)
    first = np.flatnonzero(fresh)
    if not len(first):
        return np.zeros((3, 0), dtype=np.uint64)
    return np.stack([key[order[first]], np.minimum.reduceat(tag[order], first), np.add.reduceat(n[order], first)])


def _tallies(shard: Shard, k: int, places: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """Key, tag and count of the phrases of k words at some places, by pieces."""
    for at in _pieces(len(places)):
        yield np.stack([shard.keys(places[at], k), shard.tags(places[at], k), counts[at].astype(np.uint64)])


def _rows(x: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in _pieces(x.shape[1]):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[at]).view(np.int64)) for c in x], names=["key", "tag", "n"])


def _hashed(longest: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def short_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each shard's phrases of up to SHORT words with their counts."""
        for shard, _ in _shards(batches, shard_bytes):
            for k, places, counts in intervals(shard.hash, shard.left(), min(longest, SHORT)):
                for x in _tallies(shard, k, places, counts):
                    yield from _rows(x)

    return short_phrases


def _has(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    out = np.empty(len(key), dtype=bool)
    for at in _pieces(len(key)):
        bit = (key[at] & np.uint64(8 * len(bitmap) - 1)).astype(np.int64)
        out[at] = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
    return out


def _bitmap(keys: DataFrame, size: int) -> np.ndarray:
    """`size` bits, those of the keys set. Tasks set them; what comes to the driver has this size however many keys there are."""
    place = F.col("key").bitwiseAND(F.lit(size - 1)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((size // BUCKET, BUCKET // 8), dtype=np.uint8)
    for bucket, bits in parts.collect():
        out[bucket - 1] = np.frombuffer(bits, dtype=np.uint8)
    return out.ravel()


def _phrases(words: Shard, place: np.ndarray, k: np.ndarray) -> pa.Array:
    """The k words from each place on, joined by one space."""
    at = ranges(place, k)
    data, ends = gather(words.data, words.starts[at], words.ends[at] + 1)
    data[ends[1:] - 1] = 0x20
    ends = ends[np.concatenate([[0], np.cumsum(k)])]
    keep = np.ones(len(data), dtype=bool)
    keep[ends[1:] - 1] = False
    ends = ends - np.arange(len(ends))
    return pa.StringArray.from_buffers(len(place), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[keep])))


def _found(shard: Shard, bitmap: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For k from above SHORT to `longest`: k, a place of each phrase of k words that may be frequent, and how often the shard has it."""
    follows = shard.follows.copy()
    follows[1:] &= _has(bitmap, _key(shard.pair_hashes(), 2))
    with_next = np.append(follows[1:], False)
    some = np.flatnonzero(follows | with_next).astype(np.int32)  # stretches of two words or more, whose pairs are all frequent
    if not len(some):
        return
    left = with_next.astype(np.int32) + np.int32(1)
    triples = np.zeros(len(follows), dtype=bool)  # three words from here on, that are frequent
    triples[:-2] = follows[1:-1] & follows[2:] & _has(bitmap, _key(shard.triple_hashes(), 3))
    here = np.arange(len(triples), dtype=np.int32)
    others = np.where(triples, np.int32(len(triples)), here)
    run = np.minimum.accumulate(others[::-1])[::-1] - here
    left[triples] = 2 + run[triples]
    del triples, here, others, run
    left = left[some]
    del follows, with_next
    for k, at, n in intervals(shard.hash[some], left, longest):
        if k > SHORT:
            yield k, some[at], n


def _counted(bitmap: Broadcast[np.ndarray], longest: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def longer_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's phrases of over SHORT words, as far as they may be frequent, with their counts."""
        held = [np.zeros((3, 0), dtype=np.uint64)]
        for shard, _ in _shards(batches, shard_bytes):
            for k, places, counts in _found(shard, bitmap.value, longest):
                for x in _tallies(shard, k, places, counts):
                    held.append(x)
                    if sum(y.shape[1] for y in held) > HELD:
                        held = [_joined(held)]
                        if held[0].shape[1] > HELD // 2:
                            yield from _rows(held.pop())
        if held:
            yield from _rows(_joined(held))

    return longer_phrases


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of keys and tags PROBES hashes each: of the key, of the key and the class that names it, of the key and its check."""
    for batch in batches:
        key, tag = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "tag"))
        kinds = {"known": key, "named": _with(key, tag >> np.uint64(16)), "checked": _with(key, tag & np.uint64(0xFFFF))}
        for probes in zip(*(_probes(x) for x in kinds.values())):
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in probes], names=list(kinds))


def _with(key: np.ndarray, x: np.ndarray) -> np.ndarray:
    return key ^ mix(x.astype(np.uint64) + _CLASS)


def _probes(x: np.ndarray) -> Iterator[np.ndarray]:
    for _ in range(PROBES):
        x = mix(x * _CLASS + np.uint64(1))
        yield x


def _holds(bitmap: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of x have all their bits set."""
    out = np.zeros(len(x), dtype=bool)
    for at in _pieces(len(x)):
        y = x[at]
        some = np.arange(len(y))
        for _ in range(PROBES):
            y = mix(y * _CLASS + np.uint64(1))
            there = _has(bitmap, y)
            some, y = some[there], y[there]
        out[at][some] = True
    return out


def _occurring(shard: Shard, longest: int, has: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For k = 1 to `longest`: k, the places of k words whose keys `has` has, and the keys, by pieces."""
    x, there = shard.hash, np.ones(len(shard.hash), dtype=bool)
    for k in range(1, longest + 1):
        if k > 1:
            x = _and_next(x[:-1], shard.hash[k - 1 :])
            there = there[: len(x)] & shard.follows[k - 1 :]
        for at in _pieces(len(x)):
            place = np.flatnonzero(there[at]).astype(np.int32) + np.int32(at.start)
            key = _key(x[place], k)
            ok = has(key)
            yield k, place[ok], key[ok]


def _texts(shard: Shard, names: list[str], k: int, place: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(place), TEXTS):  # some texts at a time
        at = place[i : i + TEXTS]
        lang = pa.DictionaryArray.from_arrays(pa.array(shard.lang[at], pa.int32()), pa.array(names, pa.string())).dictionary_decode()
        yield pa.RecordBatch.from_arrays([pa.array(key[i : i + TEXTS].view(np.int64)), lang, _phrases(shard, at, np.full(len(at), k)), pa.array(np.ones(len(at), dtype=np.int64))], names=["key", "lang", "phrase", "n"])


def _named(bitmaps: list[Broadcast[np.ndarray]], longest: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def named_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The phrases of frequent keys, from texts that are to name them; without a key, words by language; without a language, keys that stand for more phrases than one."""
        known, named, checked = (x.value for x in bitmaps)
        for shard, names in _shards(batches, shard_bytes):
            total = np.bincount(shard.lang, minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(names), pa.int64()), pa.array(names, pa.string()), pa.nulls(len(names), pa.string()), pa.array(total, pa.int64())], names=["key", "lang", "phrase", "n"])
            for k, place, key in _occurring(shard, longest, lambda x: _holds(known, x)):
                some = np.flatnonzero(_holds(named, _with(key, shard.text[place])))
                _, first = np.unique(key[some], return_index=True)
                yield from _texts(shard, names, k, place[some[first]], key[some[first]])
                odd = np.unique(key[~_holds(checked, _with(key, shard.checks(place, k)))])
                if len(odd):
                    none = pa.nulls(len(odd), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(odd.view(np.int64)), none, none, pa.nulls(len(odd), pa.int64())], names=["key", "lang", "phrase", "n"])

    return named_phrases


def _counted_by_text(bitmap: Broadcast[np.ndarray], longest: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each occurrence of a phrase whose key has its bit set."""
        for shard, names in _shards(batches, shard_bytes):
            for k, place, key in _occurring(shard, longest, lambda x: _has(bitmap.value, x)):
                yield from _texts(shard, names, k, place, key)

    return occurrences


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, shard_bytes: int = SHARD_BYTES, bits: int = BITS) -> DataFrame:
    """(lang, phrase, n): all words and phrases of up to `longest` words that come `least` times or more; with a null phrase, a language's words."""
    texts = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    broadcast = docs.sparkSession.sparkContext.broadcast
    added = lambda f: cut(texts.mapInArrow(f, "key long, tag long, n long").groupBy("key").agg(F.min("tag").alias("tag"), F.sum("n").alias("n")).where(F.col("n") >= least))
    frequent = added(_hashed(longest, shard_bytes))
    if longest > SHORT:
        frequent = frequent.union(added(_counted(broadcast(_bitmap(frequent, bits)), longest, shard_bytes)))
    slots = frequent.select("key", "tag").mapInArrow(_slots, "known long, named long, checked long")
    bitmaps = [broadcast(_bitmap(slots.select(F.col(kind).alias("key")), bits)) for kind in slots.columns]  # one by one: a worker reads each from a copy
    named = cut(texts.mapInArrow(_named(bitmaps, longest, min(shard_bytes, NAMED_BYTES)), "key long, lang string, phrase string, n long"))
    totals = named.where("key is null").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    phrases = named.where("phrase is not null").select("key", "lang", "phrase").distinct().join(frequent.select("key", "n"), "key")
    odd = cut(named.where("key is not null and lang is null").select("key").distinct().join(frequent.select("key"), "key"))
    if not odd.isEmpty():
        again = texts.mapInArrow(_counted_by_text(broadcast(_bitmap(odd, bits)), longest, shard_bytes), "key long, lang string, phrase string, n long")
        again = again.join(odd, "key", "left_semi").groupBy("key", "lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        phrases = phrases.join(odd, "key", "left_anti").select("key", "lang", "phrase", "n").union(again.select("key", "lang", "phrase", "n"))
    return totals.union(phrases.select("lang", "phrase", "n"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, shard_bytes: int = SHARD_BYTES, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` candidates of each language by score.

    n is the language's words, l and r how often the two parts of the lowest-scoring cut come: score = floor(1000 a n / (l r)). A candidate
    that lies in a longer one which comes as often is left out.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    counts = cut(frequent_phrases(docs, text_col, lang_col, least, longest, shard_bytes, bits))
    known = counts.where("phrase is not null")
    split = F.split("phrase", " ")
    candidates = known.withColumnRenamed("n", "a").withColumn("k", F.size(split)).where("k > 1")
    joined = lambda w, first, n: F.array_join(F.slice(w, first, n), " ")
    # what lies in a phrase that comes as often also lies in one of just one word more that does
    inner = candidates.where("k > 2").select("lang", "a", F.explode(F.array(joined(split, F.lit(1), F.col("k") - 1), joined(split, F.lit(2), F.col("k") - 1))).alias("phrase")).distinct()
    cuts = F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda c: F.struct(c.alias("cut"), joined(split, F.lit(1), c).alias("first"), joined(split, c + 1, F.col("k") - c).alias("rest")))
    each = candidates.join(inner, ["lang", "phrase", "a"], "left_anti").select("lang", "phrase", "a", F.explode(cuts).alias("x")).select("lang", "phrase", "a", "x.*")
    each = each.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]).join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    totals = counts.where("phrase is null").select("lang", "n")
    size = totals.agg(F.coalesce(F.sum(F.octet_length("lang") + 16), F.lit(0))).first()[0]
    each = each.join(F.broadcast(totals) if size <= BROADCAST_BYTES else totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    each = each.select("lang", "phrase", "a", "n", F.struct(F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide("a") * wide("n")), wide("l") * wide("r")).alias("score"), "cut", "l", "r").alias("x"))
    scored = each.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("x").alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
