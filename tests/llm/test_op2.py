import re

import numpy as np
import pytest

from recsieve.llm import near_dedup, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = {}
    for i, s in enumerate(sets):
        for x in s:
            inverted.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in inverted[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 75 * len(s | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op2_near_dedup(spark, sf).collect()), key=str)
    assert got == brute(rows)
    assert sum(not x[3] for x in got) > 20


def test_edges(spark):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 60)]
    rows = [(1, "A b"), (2, "a  B"), (3, "a b c"), (4, ""), (5, None), (6, " \t"), (7, "a b"), (7, "a b"), (9, "x y z"), (None, "p q r s t u")]
    rows += [(100 + i, " ".join([*base, f"tail{i}"])) for i in range(30)] + [(200 + i, " ".join(base[i : i + 40])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as c", "2 as n", "'x' as _k1", "'y' as root")
    got = sorted((tuple(r) for r in near_dedup.near_duplicates(df).drop("_k1", "_k2").collect()), key=str)
    assert got == brute(rows)[:0] + sorted(((d, n, c, k or (d is None and c is None)) for d, n, c, k in brute(rows)), key=str)
    kept = near_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted({c or -1 for _, _, c, _ in got})
    assert near_dedup.near_duplicates(df.where("false")).count() == 0


def test_large_group_of_changed_copies(spark):
    """Copies with changed words, many pairs of which are just below or above the threshold."""
    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in range(150)]
    rows = []
    for i in range(150):
        words = list(base)
        for x in rng.choice(150, int(rng.integers(1, 6)), replace=False):
            words[x] = f"new{rng.integers(0, 400)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in near_dedup.near_duplicates(df).drop("_k1", "_k2").collect()), key=str)
    assert got == brute(rows)
    in_parts = near_dedup.near_duplicates(df, part_members=8).drop("_k1", "_k2")
    assert sorted((tuple(r) for r in in_parts.collect()), key=str) == got
    assert 1 < sum(x[3] for x in got) < 150


def test_bucket_links_what_brute_force_links():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.choice(60, int(rng.integers(30, 60)), replace=False).astype(np.uint64)) for _ in range(600)]
    c = np.arange(600)
    a, b = near_dedup._join_bucket(c, c, sets)
    assert len(a) < 600
    root = list(range(600))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a, b):
        root[find(x)] = find(y)
    for x in range(600):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                assert find(x) == find(y)


def test_parts_link_what_the_bucket_links():
    """A bucket in parts, each pair of parts a task, rows in small batches."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(60, int(rng.integers(35, 60)), replace=False).astype(np.uint64)) for _ in range(200)]
    x = np.arange(200)
    own, of, root = np.where(x % 5, x % 3, -1), x % 4, np.where(x % 5, x, 0)  # every fifth is of the largest component
    at, low, high, left, right = near_dedup._tasks(own, of, np.full(200, 3), np.full(200, 4))
    assert len(at) == 40 * 3 + 160 * (3 + 4 - 1)
    for i in range(3):
        for j in range(4):
            here = (low == i) & (high == j)
            assert sorted(at[here & left]) == list(x[own == i]) and sorted(at[here & right]) == list(x[of == j])
    order = np.lexsort((high, low))
    at, low, high, left, right = (v[order] for v in (at, low, high, left, right))
    columns = [pa.array(np.full(len(at), 7)), *(pa.array(v) for v in (low, high, left, right, at, root[at])), pa.array([sets[a].tobytes() for a in at], pa.binary())]
    whole = pa.RecordBatch.from_arrays(columns, names=[*near_dedup.TASK, "left", "right", "c", "root", "set"])
    found = [(a, b) for out in near_dedup._across(whole.slice(i, 70) for i in range(0, len(at), 70)) for a, b in zip(*(out.column(x).to_pylist() for x in ("a", "b")))]
    one = [(0, y) for y in range(0, 200, 5)]

    def groups(links, given=()):
        root = list(range(200))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in given:
            root[find(x)] = find(y)
        for x, y in links:
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                root[find(x)] = find(y)
        return [{y for y in range(200) if find(y) == find(x)} for x in range(200)]

    assert groups(found, one) == groups(((x, y) for x in range(200) for y in range(x)), one)


def test_distance_guarantee(spark):
    """Any signature within the distance shares a key."""
    rng = np.random.default_rng(1)
    import pyarrow as pa

    for _ in range(200):
        a = rng.integers(0, 65536, near_dedup.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[rng.choice(near_dedup.SYMBOLS, near_dedup.DISTANCE, replace=False)] ^= 1
        batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([a.tobytes(), b.tobytes()])], names=["c", "sig"])
        keys = next(near_dedup._keys(iter([batch]))).to_pandas()
        assert set(keys.key[keys.c == 0]) & set(keys.key[keys.c == 1])


def test_very_long_sets_are_counted_exactly():
    """Sets of 700,000 hashes just below and just above the threshold; the pair below must not stand in for the one above."""
    rng = np.random.default_rng(8)
    pool = np.unique(rng.integers(0, 1 << 63, 900_000, dtype=np.uint64) * np.uint64(2))
    shuffled = rng.permutation(pool)
    take = lambda both, own, at: np.sort(np.concatenate([shuffled[:both], shuffled[at : at + own]]))
    # 599,998 of 800,000 is not similar, 600,000 of 800,000 is
    a, below, above = take(599_998, 100_001, 600_000), take(599_998, 100_001, 700_001), None
    both = len(np.intersect1d(a, below))
    assert (both, len(a) + len(below) - both) == (599_998, 800_000)
    assert near_dedup._join_bucket(np.arange(2), np.arange(2), [a, below]) == ([], [])
    above = np.union1d(below, a[~np.isin(a, below)][:2])
    above = above[above != below[~np.isin(below, a)][0]]
    above = above[above != below[~np.isin(below, a)][1]]
    both = len(np.intersect1d(a, above))
    assert (both, len(a) + len(above) - both) == (600_000, 799_998)
    # members 0 and 1 of one component, 2 and 3 of another: the false pair comes first, the link is still found
    found = near_dedup._join_bucket(np.arange(4), np.array([0, 0, 2, 2]), [below, a, np.unique(shuffled[-9:]), above])
    assert found == ([0], [3])  # below and above are similar
    found = near_dedup._join_bucket(np.arange(3), np.array([0, 0, 2]), [below[:400_000], a, above])
    assert found == ([1], [2])


def test_pairs_at_and_beyond_the_distance(spark):
    """Similar pairs (6 of 8 shingles) whose signatures differ in 33, 34 and 35 symbols, beside texts that link them within it."""
    pairs = [
        ("w204ceabf w286edd77 w24fc49e4 w223d9f6e w31ba2577 w327a280a w147c0d9b w223a084a w29a562b wf8d3cbc", "w12dbc530", "w2c63335b", 33),
        ("w31f596de we7c74c2 w42c21fc w1902cb86 w306a340c w359030f0 w11a2133f we5fd4f0 w64e66e7 w217a3397", "w1692d8c4", "w151aff5b", 34),
        ("w1ce19f45 w3f96b88a w2e2efa7a w3ecf24f2 w247137e1 w841311f w1c98afdd w824489c w320529c3 w10b2636c", "w3573d1a0", "w9aec7e5", 35),
    ]
    rows = []
    for i, (same, one, two, distance) in enumerate(pairs):
        texts = [f"{same} {one}", f"{same} {two}", same]
        h = [near_dedup.shingles(near_dedup.Words(np.frombuffer(t.encode(), dtype=np.uint8), np.array([0, len(t)]))) for t in texts]
        a, b = (near_dedup.signatures(*x)[0] for x in h[:2])
        assert np.count_nonzero(a != b) == distance
        for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0)):
            sets = [np.sort(h[x][0]) for x in order]
            assert len(near_dedup._join_bucket(np.arange(3), np.arange(3), sets)[0]) == 2
        rows += [(10 * i + x, t) for x, t in enumerate(texts)] if distance > 33 else [(10 * i + x, t) for x, t in enumerate(texts[:2])]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).drop("_k1", "_k2")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_very_long_text(spark):
    rng = np.random.default_rng(21)
    long = [f"v{x}" for x in rng.integers(0, 1 << 40, 120_000)]
    other = long[:100_000] + [f"u{x}" for x in range(10_000)]
    far = long[:60_000] + [f"t{x}" for x in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(far)), (4, "short text of five words"), (5, " ".join(["same"] * 300_000)), (6, " ".join(["Same"] * 200_000))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).drop("_k1", "_k2")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def places(spark, rows):
    """(members of open buckets, tasks that whole sets go to)."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    _, classes, texts, stars = near_dedup._stars(df, "doc_id", "text")
    found = near_dedup.connected_components(near_dedup.cut(near_dedup._links(stars.select("a", "b"), classes, texts)))
    out = near_dedup._open_places(stars, found, classes, texts, near_dedup.PART).selectExpr("if(own < 0, parts_own, parts_own + parts_of - 1) as n")
    return stars.count(), out.agg({"n": "sum"}).first()[0] or 0


@pytest.mark.parametrize("common", [240, 275])
def test_pages_with_one_frame_meet_no_more_often_as_they_grow(spark, common):
    """Texts that share most words and keys, of which no two are similar (similarity 0.54 and 0.67): whole sets go nowhere."""
    frame = " ".join(f"c{x}" for x in range(common))
    for n in (1_000, 4_000, 16_000):
        stars, copies = places(spark, [(i, frame + " " + " ".join(f"w{i}x{x}" for x in range(340 - common))) for i in range(n)])
        assert stars > 10 * n and copies <= n // 10


def test_pages_with_one_frame_and_copies_among_them(spark):
    """Pairs and chains of near copies in a frame of many others, long and short, keep their links."""
    rng = np.random.default_rng(6)
    frame = [f"c{x}" for x in range(90)]
    rows = []
    for i in range(300):
        words = frame[: int(rng.integers(60, 91))] + [f"w{i}x{x}" for x in range(int(rng.integers(10, 50)))]
        rows.append((i, " ".join(words)))
        for k in range(int(rng.integers(0, 3))):
            words = list(words)
            words[int(rng.integers(0, len(words)))] = f"new{i}x{k}"
            words[int(rng.integers(0, len(words)))] = f"also{i}x{k}"
            rows.append((1000 + 3 * i + k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (near_dedup.PART, 20):
        assert sorted((tuple(r) for r in near_dedup.near_duplicates(df, part_members=part).drop("_k1", "_k2").collect()), key=str) == brute(rows)


def test_classes_whose_digests_agree_get_different_numbers(spark, monkeypatch):
    from pyspark.sql import functions as F

    real, calls = F.xxhash64, []

    def poor(*columns):
        calls.append(columns)
        return F.lit(0).cast("long") if len(calls) == 1 else real(*columns)

    df = spark.createDataFrame([(bytes([x]),) for x in range(20)], "same binary")
    monkeypatch.setattr(near_dedup.F, "xxhash64", poor)
    named = near_dedup._numbered(df).collect()
    assert len(calls) == 2 and len({r.c for r in named}) == len({bytes(r.same) for r in named}) == 20
