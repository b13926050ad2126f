"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule says good, bad or nothing about a text. How often each rule says which of a good and of a bad text, and how many
texts are good, are estimated by expectation-maximisation over the counts of vote patterns of ALL texts: at most 3 to the
number of rules rows, whatever the input's size. A text is kept if the posterior probability that it is good reaches a half.
No single rule has to pass.

A base check rejects texts under 50 words, or with more than half of their words in repeated 3-word windows, whatever the rules say of
them. They count in the estimates like others.

Nulls: a null text is empty and so rejected; a null id is an id like others. Ties: a posterior of exactly a half keeps. Repeated rows get
equal results. An empty table gives no rows. A very long text is read whole, as one row. Other columns stay out of judge()'s result and
stay in keep_good()'s, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsieve.llm.common import KEY, cut, row_key
from recsieve.llm.textstats import SCHEMA, stats_batches

GOOD, BAD, NONE = 1, 0, 2


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE)


def rules() -> dict[str, Column]:
    """Votes on the columns of text_stats. A rule is sure of clear cases only."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.col
    lines, letters = F.greatest(c("n_lines"), F.lit(1)), F.greatest(c("n_letters"), F.lit(1))
    chars = F.greatest(c("word_chars"), F.lit(1))
    mean = c("word_chars") / n
    return {
        "length": _vote(n >= 100, n < 50),
        "word_length": _vote((mean >= 3) & (mean <= 9), (mean < 2) | (mean > 14)),
        "symbols_per_word": _vote(c("n_symbols") <= 0.01 * n, c("n_symbols") > 0.1 * n),
        "symbols_per_character": _vote(c("n_symbols") <= 0.002 * chars, c("n_symbols") > 0.02 * chars),
        "punctuation": _vote(c("n_other") <= 0.05 * chars, c("n_other") > 0.1 * chars),
        "lines": _vote(c("n_dup_lines") <= 0.05 * lines, c("n_dup_lines") > 0.3 * lines),
        "repeats": _vote(c("n_repeat_words") <= 0.1 * n, c("n_repeat_words") > 0.4 * n),
        "capitals": _vote(c("n_upper") <= 0.15 * letters, c("n_upper") > 0.5 * letters),
        "marks": _vote(c("n_marks") <= 0.05 * n, c("n_marks") > 0.3 * n),
        "endings": _vote(c("n_ended_lines") >= 0.6 * lines, c("n_ended_lines") < 0.1 * lines),
    }


def posterior(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The probability of good for each row of votes. Starts from trust in bad votes, which rules give in clear cases only."""
    if not len(patterns):
        return np.zeros(0)
    p = np.where((patterns == BAD).any(axis=1), 0.1, 0.95)
    seen = np.stack([patterns == v for v in (BAD, GOOD, NONE)], axis=2).astype(float)
    for _ in range(rounds):
        w = counts * p
        prior = (w.sum() + 1) / (counts.sum() + 2)
        said = {}
        for name, weight in (("good", w), ("bad", counts - w)):
            t = np.einsum("i,ijk->jk", weight, seen) + 1.0
            said[name] = t / t.sum(axis=1, keepdims=True)
        # a rule may not come out worse than chance on its own word: else the classes could swap
        for v, name in ((BAD, "good"), (GOOD, "bad")):
            other = "bad" if name == "good" else "good"
            said[name][:, v] = np.minimum(said[name][:, v], said[other][:, v])
        score = np.einsum("ijk,jk->i", seen, np.log(said["good"]) - np.log(said["bad"])) + np.log(prior) - np.log(1 - prior)
        new = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id_col, _k1, _k2, text_stats, base_failed, votes, p_good, kept."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    stats = rows.mapInArrow(stats_batches, f"id {kind}, _k1 long, _k2 long, {SCHEMA}")
    names = list(rules())
    votes = F.lit(0)
    for vote in rules().values():
        votes = votes * 3 + vote
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = cut(stats.withColumn("votes", votes.cast("int")).withColumn("base_failed", failed))
    # at most 3 ** len(names) rows come to the driver
    found = sorted((r.votes, r["count"]) for r in stats.groupBy("votes").count().collect())
    codes, counts = np.array([x[0] for x in found], dtype=np.int64), np.array([x[1] for x in found], dtype=float)
    patterns = np.stack([codes // 3 ** (len(names) - 1 - i) % 3 for i in range(len(names))], axis=1) if len(found) else np.zeros((0, len(names)))
    p = posterior(patterns, counts)
    table = docs.sparkSession.createDataFrame([(int(v), float(round(x, 9))) for v, x in zip(codes, p)], "votes int, p_good double")
    out = stats.join(F.broadcast(table), "votes", "left")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5)).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that judge() rejects."""
    kept = judge(docs, id_col, text_col).where("kept").select(*KEY).distinct()
    names = docs.columns
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), *row_key(id_col, text_col))
    return keyed.join(kept, KEY, "left_semi").select("row.*")
