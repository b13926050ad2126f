"""Benchmark decontamination by winnowing, in DataFrame and SQL functions only.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of texts whose A-Z are lower-cased. A window is `span` consecutive words of a
benchmark item; an item of fewer words, but not none, is one window. Of each run of w = span - k + 1 consecutive k-grams
the least hash is kept as a fingerprint (winnowing), so whatever shares `span` words with an item shares a fingerprint
with it. Texts with a shared fingerprint are read again: each hit is extended to the windows around it, which are held
against the items' windows word for word. Only those texts' windows near hits are expanded.

The benchmark's fingerprints, and its windows, are broadcast while their bytes (summed up before) are at most BROADCAST_BYTES, and else
joined by shuffle.

Nulls: a null text has no words. A null item_id counts for n_hit but not as an item. A null doc_id is an id like others.
Ties: windows that several items share count for each of them, in the order of their ids as texts. Repeated rows get equal results. An
empty benchmark hits nothing, an empty table of documents gives no rows. A very long text is read whole, as one row. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsieve.llm.common import KEY, cut, let, merged, row_key

SPAN = 10
GRAM = 5
BROADCAST_BYTES = 16 << 20
"""Bytes of fingerprints, or of windows with their items' ids, up to which these are broadcast."""

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(WORD), F.lit(0))


def _grams(w: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))


def _least(h: Column, w: int) -> Column:
    """The least of each w consecutive hashes."""
    return h if w == 1 else F.transform(F.sequence(F.lit(1), F.size(h) - (w - 1)), lambda i: F.array_min(F.slice(h, i, w)))


def _fingerprints(w: Column, span: int) -> Column:
    """Winnowed fingerprints of at least one k-gram in each `span` words; none for shorter texts."""
    k = min(GRAM, span)
    found = let(_grams(w, k), lambda h: F.array_distinct(_least(h, span - k + 1)))
    return F.when(F.size(w) >= span, F.transform(found, lambda x: F.struct(F.lit(span).alias("span"), x.alias("fp"))))


def _join(left: DataFrame, right: DataFrame, on: list[str], small: bool) -> DataFrame:
    return left.join(F.broadcast(right) if small else right, on)


def contaminated_words(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", span: int = SPAN) -> DataFrame:
    """Per row of docs: id_col, _k1, _k2, n_words, n_hit, spans (word ranges hit, end exclusive), items (their ids, sorted as text)."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(item_text)).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("span", F.least(F.size("w"), F.lit(span)))
    whole = items.select("item", "span", F.explode(let(F.col("w"), lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - F.col("span") + 1), lambda i: F.slice(w, i, F.col("span"))))).alias("window"))
    windows = cut(whole.groupBy("span", F.array_join("window", " ").alias("window")).agg(F.collect_set("item").alias("items")))
    spans = [r.span for r in windows.select("span").distinct().orderBy("span").collect()]  # at most `span` of them
    texts = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    ids_size = F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x) + 16)
    small = (windows.agg(F.sum(F.octet_length("window") + ids_size + 32)).first()[0] or 0) <= BROADCAST_BYTES

    marks = None
    for s in spans:
        # a window has one least k-gram: its fingerprint
        own = windows.where(F.col("span") == s).select(F.explode(_fingerprints(F.split("window", " "), s)).alias("x")).select("x.*")
        marks = own if marks is None else marks.unionByName(own)
    ids = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col))
    kind = "array<struct<start:int,`end`:int>>"
    marks = cut(marks.distinct()) if marks is not None else docs.sparkSession.createDataFrame([], "span int, fp long")

    # a text's number of words comes as one more row, of span 0, so that words are found once for all texts
    w = words(F.coalesce(F.col("text"), F.lit("")))
    own = lambda w: F.flatten(F.array_compact(F.array(F.array(F.struct(F.lit(0).alias("span"), F.size(w).cast("long").alias("fp"))), *(_fingerprints(w, s) for s in spans))))
    found = texts.select(*KEY, F.explode(let(w, own)).alias("x")).select(*KEY, "x.*")
    right = marks.withColumn("marked", F.lit(True))
    told = found.join(F.broadcast(right) if 24 * marks.count() <= BROADCAST_BYTES else right, ["span", "fp"], "left").where("marked or span = 0")
    told = cut(told.groupBy(*KEY).agg(F.max(F.when(F.col("span") == 0, F.col("fp"))).alias("n_words"), F.collect_set(F.when(F.col("span") > 0, F.struct("span", "fp"))).alias("hits")))
    n_words = ids.join(told.select(*KEY, "n_words"), KEY, "left")
    hits = told.where(F.size("hits") > 0).select(*KEY, "hits")

    def around(w: Column, s: int) -> Column:
        """The windows of s words that contain a k-gram whose hash is a hit."""
        k = min(GRAM, s)
        mine = F.transform(F.filter(F.col("hits"), lambda x: x["span"] == s), lambda x: x["fp"])
        at = let(mine, lambda m: let(_grams(w, k), lambda h: F.filter(F.sequence(F.lit(1), F.size(h)), lambda i: F.array_contains(m, F.element_at(h, i)))))
        starts = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(F.greatest(p - (s - k), F.lit(1)), F.least(p, F.size(w) - (s - 1))))))
        return F.when((F.size(w) >= s) & (F.size(mine) > 0), F.transform(starts, lambda i: F.struct((i - 1).alias("start"), F.lit(s).alias("span"), F.array_join(F.slice(w, i, s), " ").alias("window"))))

    if not spans:
        return n_words.select(F.col("id").alias(id_col), *KEY, "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast(kind).alias("spans"), F.array().cast("array<string>").alias("items"))
    near = texts.join(hits, KEY).select(*KEY, F.explode(let(w, lambda w: F.flatten(F.array_compact(F.array(*(around(w, s) for s in spans)))))).alias("x")).select(*KEY, "x.*")
    exact = _join(near, windows, ["span", "window"], small).groupBy(*KEY).agg(F.collect_set(F.struct("start", (F.col("start") + F.col("span")).alias("end"))).alias("at"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))

    out = n_words.join(exact.select(*KEY, merged(F.array_sort("at"), True).alias("spans"), "items"), KEY, "left")
    spans_col = F.coalesce("spans", F.array().cast(kind))
    n_hit = F.aggregate(spans_col, F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    return out.select(F.col("id").alias(id_col), *KEY, "n_words", n_hit.alias("n_hit"), spans_col.alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that have a benchmark window."""
    bad = contaminated_words(docs, benchmark, id_col, text_col).where("n_hit > 0").select(*KEY).distinct()
    names = docs.columns
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), *row_key(id_col, text_col))
    return keyed.join(bad, KEY, "left_anti").select("row.*")
