"""URL filters: rules, and a character language-model ratio for the URLs that no rule judges. DataFrame functions only.

URLs that rules allow and URLs that rules block train two variable-order Markov models over the characters of host and path.
A context of up to ORDER characters is in the models if it makes up MIN_SHARE of all places in the URLs that rules judge; each
character is predicted from the longest such context that it follows, smoothed by the next shorter one and so on down to none
(a Dirichlet prior of weight STRENGTH at each step). A URL's score is the mean over its characters, the end included, of the
difference of log-likelihoods.

The threshold is calibrated on scores from models that haven't seen the URL: equal URLs fall into one of two halves by a digest, and
each half is scored by counts of the other one. It lies equally many standard deviations away from either class. The verdicts then
come from the counts of all.

At most 1 / MIN_SHARE contexts of each length can have that share of the places, whatever the input, and SYMBOLS characters can follow:
that is the bound of each table that is broadcast, one for each length. Training, calibration and scoring read all rows.

Nulls: a null URL has an empty host and path, as has one without `://`; no rule fits. With one class (or none) of training
URLs the models can't differ: the method's verdict is then allow. Ties: a score at the threshold is allowed; of rules that fit, the longest
counts, and no two of one length fit one URL. Repeated rows get equal results. An empty table gives no rows. A very long URL counts
with all its characters. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsieve.llm.common import cut

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
SYMBOLS = 43
"""a-z, 0-9, the five others, and the two ends."""
STRENGTH = 5.0
ORDER = 4
MIN_SHARE = 0.0005
MODELS = ("all", "first", "second")
"""Counts of all judged URLs, and of either half of them."""
A_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, *A_Z), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (equally long ones: the first in the list), and its verdict."""
    rule, verdict = F, F
    for say, text in sorted(rules, key=lambda r: -len(r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = rule.when(fits, F.lit(text)), verdict.when(fits, F.lit(say))
    return rule, verdict


def _grams(text: Column) -> Column:
    """One per character and one for the end: ORDER characters of context, then the character."""
    folded = F.regexp_replace(F.translate(text, *A_Z), r"[^a-z0-9./_-]", "*")
    return F.regexp_extract_all(F.concat(F.lit("^" * ORDER), folded, F.lit("$")), F.lit(f"(?=(.{{{ORDER + 1}}}))"), F.lit(1))


def _nodes(grams: DataFrame) -> DataFrame:
    """(gram, and for each model and class its count and its context's): the grams of all lengths whose context has MIN_SHARE.

    grams: gram, n, said, half. Shorter grams are counted from the distinct long ones.
    """
    of = {"all": F.lit(True), "first": F.col("half") == 0, "second": F.col("half") == 1}
    names = [f"{m}_{k}" for m in MODELS for k in ("allow", "block")]
    count = {f"{m}_{k}": F.sum(F.when(of[m] & (F.col("said") == k), F.col("n")).otherwise(0)) for m in MODELS for k in ("allow", "block")}
    long = grams.groupBy("gram").agg(*(c.alias(n) for n, c in count.items()))
    short = F.transform(F.sequence(F.lit(1), F.lit(ORDER + 1)), lambda k: F.right("gram", k))
    counts = long.select(F.explode(short).alias("gram"), *names).groupBy("gram").agg(*(F.sum(n).alias(n) for n in names))
    context = Window.partitionBy(F.expr("left(gram, length(gram) - 1)"))  # at most SYMBOLS rows
    counts = cut(counts.withColumns({f"of_{n}": F.sum(n).over(context) for n in names}))
    places = counts.where("length(gram) = 1").agg(F.sum(F.col("all_allow") + F.col("all_block")).alias("places"))
    wide = F.col("of_all_allow") + F.col("of_all_block") >= MIN_SHARE * F.col("places")
    return counts.crossJoin(F.broadcast(places)).where(wide | (F.length("gram") == 1)).drop("places")


def _ratios(grams: DataFrame) -> list[DataFrame]:
    """By length of context, from none: (gram, and a log-likelihood difference for each model)."""
    nodes, names = _nodes(grams), [f"{m}_{k}" for m in MODELS for k in ("allow", "block")]
    nodes, levels = cut(nodes), []
    for k in range(ORDER + 1):
        rows = nodes.where(F.length("gram") == k + 1)
        if not k:
            p = {n: (F.col(n) + 1) / (F.col(f"of_{n}") + SYMBOLS) for n in names}
        else:
            shorter = levels[-1].select(F.col("gram").alias("_shorter"), *(F.col(f"p_{n}").alias(f"_{n}") for n in names))
            rows = rows.join(F.broadcast(shorter), F.right("gram", F.lit(k)) == F.col("_shorter"))
            p = {n: (F.col(n) + STRENGTH * F.col(f"_{n}")) / (F.col(f"of_{n}") + STRENGTH) for n in names}
        levels.append(rows.select("gram", *(c.alias(f"p_{n}") for n, c in p.items())))
    table = cut(reduce(DataFrame.unionByName, levels).select("gram", *((F.log(f"p_{m}_allow") - F.log(f"p_{m}_block")).alias(f"r_{m}") for m in MODELS)))
    return [table.where(F.length("gram") == k + 1) for k in range(ORDER + 1)]


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Per row of pages: id_col, host, path, rule, score, threshold, verdict (allow or block)."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    text = F.concat("host", "path")
    rows = rows.select("*", rule.alias("rule"), said.alias("said"), text.alias("text"), F.xxhash64(F.lit("a"), text).alias("u1"), F.xxhash64(F.lit("b"), text).alias("u2"))
    # a text has one host and path, so equal texts have one rule
    half = F.when(F.md5("text") < "8", 0).otherwise(1)
    texts = cut(rows.groupBy("u1", "u2", "text", "said").agg(F.count("*").alias("n")).withColumn("half", half))
    grams = texts.select("u1", "u2", "said", "half", "n", F.explode(_grams(F.col("text"))).alias("gram"))
    placed = grams
    levels = _ratios(grams)
    for k, level in enumerate(levels):
        named = level.select(F.col("gram").alias(f"_g{k}"), *(F.col(f"r_{m}").alias(f"_{m}{k}") for m in MODELS))
        placed = placed.join(F.broadcast(named), F.right("gram", F.lit(k + 1)) == F.col(f"_g{k}"), "left")
    longest = {m: F.coalesce(*(F.col(f"_{m}{k}") for k in reversed(range(len(levels))))) for m in MODELS}
    unseen = F.when(F.col("half") == 0, longest["second"]).otherwise(longest["first"])
    scores = placed.groupBy("u1", "u2").agg(F.round(F.avg(longest["all"]), 9).alias("score"), F.round(F.avg(unseen), 9).alias("unseen"))
    scored = cut(rows.drop("text").join(scores, ["u1", "u2"], "left").drop("u1", "u2"))
    found = {r.said: r for r in scored.where("said is not null").groupBy("said").agg(F.avg("unseen").alias("mean"), F.stddev_pop("unseen").alias("sd")).collect()}
    if len(found) == 2:
        a, b = found["allow"], found["block"]
        threshold = (a["mean"] * b["sd"] + b["mean"] * a["sd"]) / (a["sd"] + b["sd"]) if a["sd"] + b["sd"] else (a["mean"] + b["mean"]) / 2
        method = F.when(F.col("score") >= round(threshold, 9), "allow").otherwise("block")
    else:
        threshold, method = None, F.lit("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", "score", F.lit(threshold).cast("double").alias("threshold"), F.coalesce("said", method).alias("verdict"))
