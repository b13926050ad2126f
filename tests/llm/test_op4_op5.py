import functools
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from recsieve.llm import mixing, queries, url_filter

A_Z = str.maketrans(*url_filter.A_Z)


def judge(rows):
    out = []
    for i, u in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "", re.S)
        host, path = (m[1].translate(A_Z), m[2]) if m else ("", "")
        rule = said = None
        for say, text in sorted(url_filter.RULES, key=lambda r: len(r[1])):
            h, _, p = text.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                rule, said = text, say
        out.append((i, host, path, rule, said))
    order, fold = url_filter.ORDER, lambda h, p: re.sub(r"[^a-z0-9./_-]", "*", (h + p).translate(A_Z))
    half = lambda h, p: 0 if hashlib.md5((h + p).encode()).hexdigest() < "8" else 1
    places = lambda s: [("^" * order + s)[j : j + order] + c for j, c in enumerate(s + "$")]
    seen = {(m, k): Counter() for m in ("all", 0, 1) for k in ("allow", "block")}
    for _, h, p, _, said in out:
        if said:
            for g in places(fold(h, p)):
                for m in ("all", half(h, p)):
                    seen[m, said].update(g[j:] for j in range(order + 1))
    total = {key: Counter() for key in seen}
    for key, c in seen.items():
        for g, n in c.items():
            total[key][g[:-1]] += n
    enough = url_filter.MIN_SHARE * (total["all", "allow"][""] + total["all", "block"][""])
    used = lambda context: total["all", "allow"][context] + total["all", "block"][context] >= enough

    @functools.cache
    def p(key, g):
        if len(g) == 1:
            return (seen[key][g] + 1) / (total[key][""] + 43)
        return (seen[key][g] + 5 * p(key, g[1:])) / (total[key][g[:-1]] + 5) if used(g[:-1]) else p(key, g[1:])

    score = lambda m, s: round(float(np.mean([math.log(p((m, "allow"), g)) - math.log(p((m, "block"), g)) for g in places(s)])), 9)
    scores = [score("all", fold(h, q)) for _, h, q, _, _ in out]
    unseen = [score(1 - half(h, q), fold(h, q)) for _, h, q, _, _ in out]
    stats = {k: (np.mean(x), np.std(x)) for k in ("allow", "block") if (x := [s for s, r in zip(unseen, out) if r[4] == k])}
    if len(stats) == 2:
        (ma, sa), (mb, sb) = stats["allow"], stats["block"]
        at = round((ma * sb + mb * sa) / (sa + sb) if sa + sb else (ma + mb) / 2, 9)
    else:
        at = -math.inf
    return [(*r[:4], r[4] or ("allow" if s >= at else "block")) for r, s in zip(out, scores)], scores, at


def test_urls(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    want, scores, at = judge(rows)
    close = {w[0] for w, s in zip(want, scores) if abs(s - at) < 1e-6}
    got = {r.page_id: tuple(r) for r in queries.op4_url_filter(spark, sf).collect()}
    assert len(got) == len(want)
    assert all(got[w[0]] == w or w[0] in close for w in want)
    assert len({w[4] for w in want if w[3] is None}) == 2


def test_url_edges(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://EXAMPLE.org"), (4, "http://a.example.org/es/?x#y"), (5, "http://example.org/en/12"), (6, "http://x.com/fr/a"), (6, "http://x.com/fr/a"), (7, "http://x.com/de/b"), (8, "http://notorg/"), (9, "ftp://ü.net/a b?c"), (None, "http://q.net/" + "z" * 20_000), (10, ""), (11, "://"), (12, "http://org/x")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as id", "3 as gram")
    want, _, _ = judge(rows)
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert url_filter.judge_urls(df.where("false")).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(df.where("page_id in (1, 2, 8)")).collect()} == {"allow"}


def totals(rows):
    t = defaultdict(int)
    for r in rows:
        t[r.source] += r.n_tokens
    return t


def test_mix_weights(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op5_source_mixing(spark, sf).collect()
    have = totals(docs.select("source", mixing.tokens(docs.text).alias("n_tokens")).collect())
    mixed, weight = totals(got), {r.source: r.weight for r in got}
    size = sum(mixed.values())
    assert abs(sum(weight.values()) - 1) < 1e-9
    for s in have:
        assert abs(mixed[s] / size - weight[s]) < 0.02
        assert 0.99 <= mixed[s] / have[s] <= mixing.MAX_REPEATS + 1e-9
    assert max(weight[s] / have[s] for s in have) / min(weight[s] / have[s] for s in have) <= mixing.MAX_REPEATS * 1.0001
    copies = Counter((r.doc_id, r.epoch) for r in got)
    assert set(copies.values()) == {1}
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.select("doc_id").collect()}
    first = sorted(got, key=lambda r: r.mix_order)[: len(got) // 2]
    half = totals(first)
    assert all(abs(half[s] / sum(half.values()) - weight[s]) < 0.06 for s in have)


def test_mix_budget_entropy_and_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "w " * int(rng.integers(1, 40)), f"s{min(int(rng.exponential(1.2)), 4)}") for i in range(2000)] + [(5000, None, "s0"), (5001, "", "empty"), (5002, "a b c", None), (5002, "a b c", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as row", "2 as h", "3 as weight")
    have = Counter()
    for _, t, s in rows:
        have[s] += len((t or "").split())
    got = mixing.mix(df, budget=12_000).collect()
    mixed = totals(got)
    assert sum(mixed.values()) <= 12_000
    weight = {r.source: r.weight for r in got if r.n_tokens}
    for s in have:
        if have[s]:
            assert weight[s] * 12_000 - 45 <= mixed[s] <= weight[s] * 12_000 + 1e-6
    assert {5000, 5001} <= {r.doc_id for r in got}
    p = np.array([n for n in have.values() if n], dtype=float)
    p /= p.sum()
    h = -(p * np.log(p)).sum()
    stats = spark.createDataFrame([(s, n) for s, n in have.items()], "source string, t long")
    for goal in (h + 0.1, h - 0.1):
        m = mixing.exponent(stats, 1.0, 1e9, goal)
        w = p**m / (p**m).sum()
        assert abs(-(w * np.log(w)).sum() - goal) < 1e-6
    assert mixing.mix(df.where("false")).count() == 0
    assert mixing.mix(df.where("doc_id >= 5000")).count() == 4


def spark_hash(*values):
    """Spark's xxhash64 of longs, ints and strings; a null leaves the hash as it is."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else int(v[0]).to_bytes(4, "little", signed=True) if isinstance(v, tuple) else int(v).to_bytes(8, "little", signed=True)
            # an int is hashed in four bytes, a long in eight
            seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def brute_mix(rows, max_repeats=2.0):
    """(doc_id, epoch, mix_order) of all copies, from (doc_id, text, source): the plan and every document's place, in plain Python."""
    docs = []
    for d, text, source in rows:
        keys = spark_hash("id", d), spark_hash("text", text)
        docs.append((d, source, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), keys, spark_hash((mixing.SEED,), *keys)))
    have, count = Counter(), Counter()
    for _, s, n, _, _ in docs:
        have[s] += n
        count[s] += 1
    total = sum(have.values())
    shares = [n / total for n in have.values() if n]
    m = max(0.0, 1 - math.log(max_repeats) / math.log(max(shares) / min(shares))) if max(shares) > min(shares) else 0.0
    raw = {s: (n / total) ** m if n else 0.0 for s, n in have.items()}
    z, most = sum(raw.values()), max(have[s] / raw[s] for s in have if have[s])
    out, power = [], lambda x: 2 ** math.ceil(math.log2(max(x, 1)))
    for s in have:
        epochs = round(raw[s] / z * most * z / have[s], 6) if have[s] else 0.0
        blocks = min(power(count[s] / mixing.BLOCK_DOCS), power(8 * math.sqrt(count[s])))

        def place(block, epoch, s=s, blocks=blocks):
            mixed = spark_hash((mixing.SEED,), s, (epoch,))
            return (block * (2 * (mixed % (1 << 20)) + 1) + (mixed >> 21) % (1 << 20)) % blocks

        left, last = int((epochs - int(epochs)) * have[s] + 1e-6), set()
        own = [d for d in docs if d[1] == s]
        for d in sorted((d for d in own if d[2]), key=lambda d: (place(d[4] % blocks, int(epochs)), d[4] % (1 << 64), d[3])):
            if d[2] > left:
                break
            left -= d[2]
            last.add(d[0])
        for d, _, n, _, h in own:
            for epoch in range(int(epochs) + (d in last) if n else 1):
                out.append((d, epoch, round((epoch + (place(h % blocks, epoch) + h % (1 << 64) / 2**64) / blocks) / max(epochs, 1), 5)))
    return sorted(out, key=str)


def test_mix_copies_against_brute_force(spark):
    rng = np.random.default_rng(4)
    sizes = {"big": 1500, "middle": 400, "small": 120, None: 30}
    rows = [(10_000 * i + x, "w " * int(rng.integers(0, 40)), s) for i, (s, n) in enumerate(sizes.items()) for x in range(n)] + [(90_000, None, "big"), (90_001, "", "none"), (90_002, "long " * 3_000, "middle")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = brute_mix(rows)
    assert sorted((r.doc_id, r.epoch) for r in got) == sorted(w[:2] for w in want)
    assert max(abs(a[2] - b[2]) for a, b in zip(sorted((r.doc_id, r.epoch, r.mix_order) for r in got), sorted(want))) < 1e-4


def test_budgets_out_of_reach(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (2, "d", "y")], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        mixing.mix(df, budget=9, max_repeats=2)
    assert sum(r.n_tokens for r in mixing.mix(df, budget=8, max_repeats=2).collect()) == 8
