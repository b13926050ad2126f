import hashlib
import re
import zlib

import numpy as np
import pytest

from recsieve.llm import queries
from recsieve.llm.periodic_runs import doubled, find_runs, least_overlap

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, shortest=6, times=4):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(shortest, times * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute(text, shortest=6, times=4):
    w = WORD.findall(text or "")
    runs = brute_runs(w, shortest, times)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone)


def test_whole_table(spark, sf):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf).collect()}
    n = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = WORD.findall(r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(len(w))]
        _, runs, kept = brute(" ".join(w))
        x, n = got[r.doc_id], n + len(runs)
        best = min(runs, key=lambda t: (-t[1] / t[2], t[0], t[2])) if runs else (None,) * 3
        assert (x.n_runs, (x.start, x.length, x.period)) == (len(runs), best)
        assert x.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert x.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert len(got) == 200 and n > 10


def texts():
    rng = np.random.default_rng(4)
    out = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "  a a\ta a\na a b", "a b " * 4, "a b " * 3 + "a", "x " * 1000, "é ü é ü é ü é ü é", "b a a a a a a b a a a a a a"]
    fib = ["a", "b"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    out.append(" ".join(fib[-1]))
    thue = "a"
    while len(thue) < 2048:
        thue += thue.translate(str.maketrans("ab", "ba"))
    out += [" ".join(thue), " ".join(thue * 4)]
    for size in (2, 3, 6):
        for n in (7, 40, 130, 300):
            out += [" ".join(f"w{x}" for x in rng.integers(0, size, n)) for _ in range(8)]
    for _ in range(60):  # nested and neighbouring periods, with changed words
        w = []
        for _ in range(int(rng.integers(1, 6))):
            unit = [f"u{x}" for x in rng.integers(0, 4, int(rng.integers(1, 12)))]
            w += (unit * int(rng.integers(1, 9)))[: int(rng.integers(1, 80))]
        for x in rng.integers(0, len(w), int(rng.integers(0, 3))):
            w[x] = "new"
        out.append(" ".join(w * int(rng.integers(1, 5))))
    return out


@pytest.mark.parametrize("shortest, times", [(6, 4), (2, 2), (3, 2), (10, 3), (4, 5)])
def test_against_brute_force(spark, shortest, times):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a " * 9), (0, "a " * 9), (0, "a " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as runs", "3 as n_words").repartition(3)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) for r in find_runs(df, shortest=shortest, times=times).collect()), key=str)
    assert got == sorted(((d, *brute(t, shortest, times)) for d, t in rows), key=str)


def test_a_very_long_text_and_no_rows(spark):
    unit = " ".join(f"w{x}" for x in np.random.default_rng(1).integers(0, 10**6, 50_000))
    df = spark.createDataFrame([(1, " ".join([unit] * 5)), (2, "x " * 400_000)], "doc_id long, text string")
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed_text) for r in find_runs(df).collect()}
    assert got == {1: ([(0, 250_000, 50_000)], unit), 2: ([(0, 400_000, 1)], "x")}
    assert find_runs(df.where("false")).count() == 0


def test_least_overlap_and_exact_ranks():
    assert [least_overlap(*x) for x in ((6, 4), (2, 2), (3, 2), (10, 3), (4, 5))] == [5, 1, 2, 7, 4]
    x = np.array([1, 2, 1, 2, 1, 3], dtype=np.int32)
    for j, r in enumerate(doubled(x, 4)):
        same = [[tuple(x[a : a + 2**j]) == tuple(x[b : b + 2**j]) for b in range(len(r))] for a in range(len(r))]
        assert (np.equal.outer(r, r) == np.array(same)).all()
