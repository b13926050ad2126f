import hashlib
import re
from collections import Counter

from recsieve.llm import queries
from recsieve.llm.substring_dedup import HOT, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone |= set(range(i, i + k))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(d, n, r, hashlib.sha256(t.encode()).hexdigest()) for d, n, r, t in brute(rows, 35)]
    got = sorted((tuple(r) for r in queries.op1_substring_dedup(spark, sf).collect()), key=str)
    assert got == want
    assert any(x[2] for x in got)


def test_edges(spark):
    rows = [(1, "a b c d e f"), (2, "x y a  b\tc d\ne q"), (None, "z a b c d e"), (3, None), (4, ""), (5, "u u u u u u u u"), (6, "one two three four five six"), (6, "one two three four five six"), (7, "  a b c d e ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as mini", "'x' as _k1", "2 as id")
    for hot in (HOT, 400, 1):
        got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df, k=5, m=2, hot=hot).collect()), key=str)
        assert got == brute(rows, 5)
    assert remove_repeats(df.where("false"), k=5, m=2).count() == 0


def test_periodic_and_very_long_texts(spark):
    """Long runs with one minimiser, passages in many texts and exact copies, with hot minimisers at both levels."""
    import numpy as np

    rng = np.random.default_rng(3)
    passage = " ".join(f"p{x}" for x in range(60))
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    rows = [(1, "a b " * 30_000), (2, "b a " * 4_000 + words(50)), (3, "x " * 20_000), (4, "one two three " * 5_000 + "end"), (5, words(100_000)), (6, " ".join(str(i % 5000) for i in range(12_000)))]
    rows += [(10 + i, f"{words(20)} {passage} {words(20)}") for i in range(40)] + [(100 + i, words(40) if i % 2 else f"{passage} same end " + "tail " * 40) for i in range(40)]
    rows += [(200 + i, f"{passage[:200]} {words(5)} {passage}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, 35)
    for hot in (HOT, 20_000, 3_000):
        got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df, hot=hot).collect()), key=str)
        assert [g[:3] for g in got] == [w[:3] for w in want] and got == want


def test_runs_are_cut(spark):
    import numpy as np

    from recsieve.llm.substring_dedup import PIECE, Words, super_kmers

    data = np.frombuffer(b"a b " * 5_000, dtype=np.uint8)
    for seed in (0, 7):
        doc, first, n, mini, several = super_kmers(Words(data, np.array([0, len(data)])), 35, 8, seed)
        assert n.max() == PIECE and n.sum() == 10_000 - 34 and list(first) == list(range(0, 10_000 - 34, PIECE)) and len(set(mini)) == 1 and several.all()
