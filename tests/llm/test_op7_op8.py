import math
import re
import zlib
from collections import Counter

import numpy as np

from recsieve.llm import quality_model, quality_rules, queries
from recsieve.llm.textstats import NAMES, text_stats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w))


BLANK = " \t\n\r\x0b\x0c"


def fourteen(text):
    """text_stats of one text, in the order of NAMES."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x.strip(BLANK) for x in text.split("\n") if WORD.search(x)]
    letters = [c for c in text if c.isascii() and c.isalpha()]
    other = sum("\x21" <= c <= "\x7e" and not c.isalnum() for c in text)
    first = base(text)[:5]
    return (*first, len(lines), sum(x[-1] in ".!?" for x in lines), sum(c.isupper() for c in letters), len(letters), sum(c in "0123456789" for c in text), sum(c in "!?" for c in text), other, len(set(w)), sum(len(x) > 12 for x in w))


def plain_votes(s):
    """One vote a rule on fourteen(): 1 good, 0 bad, 2 neither."""
    n, chars, symbols, dup, repeats, lines, ended, upper, letters, _, marks, other, _, _ = s
    words, chars_, lines_, letters_ = max(n, 1), max(chars, 1), max(lines, 1), max(letters, 1)
    mean = chars / words
    said = [
        (words >= 100, words < 50),
        (3 <= mean <= 9, mean < 2 or mean > 14),
        (symbols <= 0.01 * words, symbols > 0.1 * words),
        (symbols <= 0.002 * chars_, symbols > 0.02 * chars_),
        (other <= 0.05 * chars_, other > 0.1 * chars_),
        (dup <= 0.05 * lines_, dup > 0.3 * lines_),
        (repeats <= 0.1 * words, repeats > 0.4 * words),
        (upper <= 0.15 * letters_, upper > 0.5 * letters_),
        (marks <= 0.05 * words, marks > 0.3 * words),
        (ended >= 0.6 * lines_, ended < 0.1 * lines_),
    ]
    return tuple(0 if bad else 1 if good else 2 for good, bad in said)


def plain_posterior(votes):
    """Expectation-maximisation over the texts one by one, without arrays: the probability of good by vote pattern."""
    if not votes:
        return {}
    p = {v: 0.1 if 0 in v else 0.95 for v in votes}
    k = len(votes[0])
    counts = Counter(votes)
    for _ in range(200):
        good = [[1.0] * 3 for _ in range(k)]
        bad = [[1.0] * 3 for _ in range(k)]
        for v, c in counts.items():
            for i, x in enumerate(v):
                good[i][x] += c * p[v]
                bad[i][x] += c * (1 - p[v])
        good, bad = ([[x / sum(row) for x in row] for row in table] for table in (good, bad))
        for g, b in zip(good, bad):
            g[0] = min(g[0], b[0])
            b[1] = min(b[1], g[1])
        prior = (sum(c * p[v] for v, c in counts.items()) + 1) / (len(votes) + 2)
        new = {}
        for v in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(good[i][x] / bad[i][x]) for i, x in enumerate(v))
            new[v] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        step = max(abs(new[v] - p[v]) for v in new)
        if step < 1e-9:
            break
        p = new
    return p


def plain_verdicts(texts):
    """(p_good, kept) for each text."""
    seen = [fourteen(t) for t in texts]
    failed = [base(t)[5] for t in texts]
    votes = [plain_votes(s) for s in seen]
    p = plain_posterior(votes)
    return [(p[v], not f and p[v] >= 0.5) for v, f in zip(votes, failed)]


ODD = ["", None, " \n\t\n", "é ü\n\né ü.\n # a", "a b c a b c!\r\n\x0b\nA1 \x85 \u00a0.\u00a0", "x" * 100_000, "Wörter sind länger?! " * 30_000]


def test_all_counts_against_plain_python(spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    data = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    got = text_stats(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)
    for row, text in zip(got, texts):
        assert tuple(row) == fourteen(text)


def test_verdicts_against_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = dict(zip(texts, plain_verdicts(list(texts.values()))))
    got = queries.op8_quality_rules(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        p, kept = want[r.doc_id]
        assert r.kept == kept
        assert abs(r.p_good - p) < 1e-6
    assert {r.kept for r in got if not r.base_failed} == {True, False}


def test_base_counts_of_whole_table(spark, sf):
    rows = {r.doc_id: base(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op8_quality_rules(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rows[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_rules_follow_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op8_quality_rules(spark, sf).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert np.mean(good) > 0.98
    assert np.mean(bad) < 0.5


def test_rules_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (3, " \n\t\n"), (None, "é ü\n\né ü\n # a"), (5, "a b c a b c"), (6, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as votes", "2 as n_words", "3 as id")
    got = quality_rules.judge(df).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted((str(d), *base(t)) for d, t in rows)
    assert quality_rules.keep_good(df).columns == df.columns
    assert quality_rules.judge(df.where("false")).count() == 0
    assert quality_rules.keep_good(df.where("false")).count() == 0


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    votes = np.stack([np.where(rng.random(20_000) < 0.3, 2, np.where(rng.random(20_000) < acc, truth, ~truth)) for acc in (0.95, 0.9, 0.85, 0.8, 0.6)], axis=1).astype(int)
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = quality_rules.posterior(patterns, counts.astype(float))[which.ravel()]
    majority = (votes == 1).sum(1) >= (votes == 0).sum(1)
    assert ((p >= 0.5) == truth).mean() > (majority == truth).mean()


def test_model_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op7_quality_model(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    y = np.array([labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels])
    s = np.array([r.score for r in got if r.held_out and r.doc_id in labels])
    auc = (s[y == 1][:, None] > s[y == 0][None, :]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).mean()
    print("auc", auc, "accuracy", ((s >= 0.5) == y).mean(), "share of good", y.mean())
    assert auc > 0.95


def test_model_edges(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, None), (None, ""), (4, "z " * 50_000)], "doc_id long, text string").selectExpr("*", "1 as label", "2 as id")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1)], "doc_id long, quality int")
    assert quality_model.score(docs, quality_model.train(docs, labels)).count() == 5
    none = quality_model.train(docs, labels.where("false"))
    assert {r.score for r in quality_model.score(docs, none).collect()} == {0.5}
    assert quality_model.score(docs.where("false"), none).count() == 0


def test_scores_against_a_plain_walk(spark, sf):
    """Every score of the query from features counted in plain Python, one node after another."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    t = quality_model.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = queries.op7_quality_model(spark, sf).collect()
    assert len(got) == len(texts) and len(t.roots)
    for r in got:
        c = dict(zip(NAMES, fourteen(texts[r.doc_id])))
        n, lines, letters, chars = (max(c[x], 1) for x in ("n_words", "n_lines", "n_letters", "word_chars"))
        x = [np.log1p(float(c["n_words"])), c["word_chars"] / n, c["n_symbols"] / n, c["n_dup_lines"] / lines, c["n_repeat_words"] / n, c["n_ended_lines"] / lines, c["n_upper"] / letters, c["n_letters"] / chars, c["n_digits"] / chars, c["n_marks"] / n, c["n_unique_words"] / n, c["n_long_words"] / n, n / lines]
        total = t.base
        for node in t.roots:
            while t.left[node] != node:
                node = t.left[node] if x[t.feature[node]] <= t.threshold[node] else t.right[node]
            total += t.value[node]
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9


def test_rows_learned_from_are_bounded(spark, monkeypatch):
    """One id with many texts can't bring more rows to the driver than the sample's bound; below it every row counts."""
    docs = spark.createDataFrame([(1, f"text {i} " * (i + 1)) for i in range(300)] + [(i, "plain words") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    sizes = []
    monkeypatch.setattr(quality_model, "fit", lambda x, y: sizes.append(len(y)))
    usable = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 3 != 1]
    for bound in (10, 10_000):
        quality_model.train(docs, labels, sample=bound)
    assert sizes[0] <= 10 and sizes[1] == len(usable) - (1 in usable) + 300 * (1 in usable)


def test_ties_at_a_half(spark):
    """Without labels each score is exactly a half, which is predicted 1."""
    half = quality_model.fit(np.zeros((0, 13)), np.zeros(0))
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {(r.score, r.predicted) for r in quality_model.score(docs, half).selectExpr("score", "cast(score >= 0.5 as int) as predicted").collect()} == {(0.5, 1)}


def test_trees_match_plain_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = quality_model.fit(x, y)
    assert ((t.score(x) >= 0.5) == y).mean() > 0.97
    for row in x[:20]:
        total = t.base
        for node in t.roots:
            while t.left[node] != node:
                node = t.left[node] if row[t.feature[node]] <= t.threshold[node] else t.right[node]
            total += t.value[node]
        assert abs(1 / (1 + np.exp(-total)) - t.score(row[None])[0]) < 1e-12
