import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from recsieve.llm import collocations as C
from recsieve.llm import queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest, top):
    """rows of (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    most = Counter()
    for (lang, p), a in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                most[lang, p[i : i + k]] = max(most[lang, p[i : i + k]], a)
    out = []
    for (lang, p), a in cand.items():
        if 100 * most[lang, p] >= 100 * a:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), l, r))
    got, rank = [], Counter()
    for lang, score, a, p, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], p.decode(), -a, l, r, n[lang], -score))
    return got


def result(df, **options):
    return sorted(tuple(r) for r in C.collocations(df, **options).collect())


def rows():
    rng = np.random.default_rng(2)
    out = [(None, "A b\tc  d. a b"), ("und", "a b c d e f, x"), ("en", None), ("en", ""), (None, None), ("fr", " \t.,;\n "), ("fr", "l'été à été É"), ("é", "A B! a b? a  b\ra b\x0ba b\x0ca b"), ("", "a b a b a b")]
    for lang, words in (("en", 6), ("de", 12), (None, 4)):
        for _ in range(40):
            w = [f"W{x}" + str(rng.choice(["", "", "", ".", ",", ":", "\n", "\t"])) for x in rng.zipf(1.6, int(rng.integers(0, 60))) % words]
            out.append((lang, str(rng.choice([" ", "  "])).join(w)))
    out += [("en", "one two three four five six seven")] * 9 + [("en", "x two three y")] * 3 + [("de", "aa aa aa aa aa aa aa")] * 2
    return out


@pytest.mark.parametrize("least, longest, top, shard, bits", [(2, 5, 2000, C.SHARD_BYTES, C.BITS), (5, 5, 12, 300, C.BITS), (3, 7, 5, 1, C.BUCKET), (1, 2, 2000, 2000, C.BUCKET)])
def test_against_brute_force(spark, least, longest, top, shard, bits):
    """In shards of one text, of some, of all; and with a small bitmap."""
    data = rows()
    df = spark.createDataFrame(data, "lang string, text string").selectExpr("*", "1 as phrase", "2 as n", "3 as key").repartition(5)
    want = brute(data, least, longest, top)
    assert result(df, least=least, longest=longest, top=top, shard_bytes=shard, bits=bits) == want and want


def test_bits_that_many_hashes_share(spark):
    """A bitmap that is full keeps everything, and changes nothing."""
    rng = np.random.default_rng(8)
    data = [("en", " ".join(f"w{x}" for x in rng.integers(0, 30_000, 60_000))), ("en", " ".join(f"w{x}" for x in rng.integers(0, 40, 4_000)))] * 3
    df = spark.createDataFrame(data, "lang string, text string").repartition(3)
    assert result(df, least=3, bits=C.BUCKET) == result(df, least=3) == brute(data, 3, 5, 2000)


def test_no_rows_and_a_long_text(spark):
    data = [("en", "aa bb cc " * 100_000)]
    df = spark.createDataFrame(data, "lang string, text string")
    assert result(df.where("false")) == []
    assert result(df.selectExpr("lang", "'' as text")) == []
    assert result(df) == brute(data, 100, 5, 2000) != []


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts as a very large corpus has them."""
    n, a = 9 * 10**16, 10**15 + 7
    counts = spark.createDataFrame([("en", None, n), ("en", "a", 3 * a), ("en", "b", 2 * a + 1), ("en", "a b", a)], "lang string, phrase string, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda *_: counts)
    assert result(spark.createDataFrame([], "lang string, text string")) == [("en", 1, "a b", a, 3 * a, 2 * a + 1, n, 1000 * a * n // (3 * a * (2 * a + 1)))]


def test_a_shard_of_three_words(spark):
    """Fewer words than the stretches whose ranks are doubled."""
    for data in ([("en", "aa bb cc")], [("en", "aa bb cc")] * 3 + [("en", "aa bb")] * 2):
        df = spark.createDataFrame(data, "lang string, text string")
        assert result(df, least=1, shard_bytes=1) == brute(data, 1, 5, 2000) != []


@pytest.mark.parametrize("shared", [False, True])
def test_memory_of_a_shard(shared):
    """What both passes hold for each word of a shard, with all its phrases frequent too."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 200) % 50_000) for _ in range(6000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])

    class Bitmap:
        value = np.full(C.BITS // 8, 255 if shared else 0x11, dtype=np.uint8)

    for run in (C._hashed(5, C.SHARD_BYTES), C._counted(Bitmap, 5, C.SHARD_BYTES)):
        for _ in run(iter([batch.slice(0, 100)])):
            pass
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100 * 1_200_000


def test_phrases_travel_about_once(spark, monkeypatch):
    """A phrase that all shards have is named by few of them; texts of one class, copies too, name it once a shard at most."""
    rng = np.random.default_rng(6)
    data = [("en", " ".join(f"w{x}" for x in rng.integers(0, 12, 60))) for _ in range(200)] + [("en", "same " * 7)] * 4
    df = spark.createDataFrame(data, "lang string, text string").repartition(4)
    sent, kind = [], type(df)

    def counted(self, f, schema, *more, as_it_is=kind.mapInArrow):
        out = as_it_is(self, f, schema, *more)
        if "phrase" in schema:
            sent.append(out.where("phrase is not null").count())
        return out

    monkeypatch.setattr(kind, "mapInArrow", counted)
    frequent = C.frequent_phrases(df, least=20, shard_bytes=500).where("phrase is not null").count()
    assert frequent > 150 and sum(sent) <= 1.1 * frequent + 4


@pytest.mark.parametrize("key", [(1 << 12) - 1, (1 << 20) - 1])
def test_keys_that_phrases_share(spark, monkeypatch, key):
    """With keys of 12 bits all phrases share theirs, with 20 bits some do: they are counted by their text."""
    monkeypatch.setattr(C, "_KEY", np.uint64(key))
    cloudpickle.register_pickle_by_value(C)
    try:
        rng = np.random.default_rng(9)
        data = [("en", " ".join(f"w{x}" for x in rng.zipf(1.2, 6_000) % 3_000)), ("de", " ".join(f"w{x}" for x in rng.integers(0, 9, 3_000)))] * 2
        df = spark.createDataFrame(data, "lang string, text string").repartition(3)
        assert result(df, least=3, shard_bytes=5000) == brute(data, 3, 5, 2000)
    finally:
        cloudpickle.unregister_pickle_by_value(C)
