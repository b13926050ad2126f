"""Duplicate records: lookups as joins, tolerance joins, canonical choice."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsieve.functions.amounts import amounts_match


def key_lookup(deals: DataFrame, pages: DataFrame) -> DataFrame:
    """Each deal (id, slug, report_key) with the pages (page_id, report_key, scheme, slug) of its v3 key or legacy prefix.

    Two equi-joins in union instead of a disjunction, which would be a nested loop.
    """
    exact = deals.join(pages.where("scheme = 'v3'").select("page_id", "report_key", "scheme"), "report_key").select("id", "page_id", "scheme")
    legacy = deals.join(pages.where("scheme = 'legacy'").select("page_id", "slug", "scheme"), "slug").select("id", "page_id", "scheme")
    return exact.unionByName(legacy)


def _bucket(amount: Column, tolerance: float) -> Column:
    """Matching positive amounts are at most -ln(1 - tolerance) apart in logarithm, so they lie in the same or in neighbouring
    buckets of that width (a little wider, for rounding). Zeros have a bucket of their own, as have all negative amounts."""
    width = -math.log(1 - tolerance) * 1.000001
    return F.when(amount > 0, F.floor(F.log(amount.cast("double")) / width)).when(amount == 0, -1000).when(amount < 0, -2000)


def _around(bucket: Column) -> Column:
    return F.explode(F.when(bucket <= -1000, F.array(bucket)).otherwise(F.array(bucket - 1, bucket, bucket + 1)))


def tolerance_pairs(deals: DataFrame, by: str, tolerance: float = 0.05) -> DataFrame:
    """Pairs (a, b), a < b, of deals (id, amount) that agree in `by` and match in amount: an equi-join on `by` and the amount's bucket."""
    rows = deals.select(by, "id", "amount", _bucket(F.col("amount"), tolerance).alias("at"))
    left = rows.select(by, F.col("id").alias("a"), F.col("amount").alias("amount_a"), F.col("at").alias("bucket"))
    right = rows.select(by, F.col("id").alias("b"), F.col("amount").alias("amount_b"), _around(F.col("at")).alias("bucket"))
    return left.join(right, [by, "bucket"]).where((F.col("a") < F.col("b")) & amounts_match(F.col("amount_a"), F.col("amount_b"), tolerance)).select("a", "b")


def tolerance_links(deals: DataFrame, by: str, tolerance: float = 0.05) -> DataFrame:
    """Per deal (id, amount): class_id (the least id of those that agree in `by` and amount) and n_links, the number of deals it matches.

    Only classes are joined, so equal records, however many, are counted and not paired. A deal without `by` or amount has no class and no links.
    """
    classes = deals.where(F.col(by).isNotNull() & F.col("amount").isNotNull()).groupBy(by, "amount").agg(F.min("id").alias("class_id"), F.count("*").alias("n"))
    rows = classes.withColumn("at", _bucket(F.col("amount"), tolerance))
    right = rows.select(by, F.col("amount").alias("amount_b"), F.col("n").alias("n_b"), _around(F.col("at")).alias("bucket"))
    pairs = rows.withColumnRenamed("at", "bucket").join(right, [by, "bucket"]).where(amounts_match(F.col("amount"), F.col("amount_b"), tolerance))
    links = pairs.groupBy(by, "amount").agg(F.first("class_id").alias("class_id"), (F.sum("n_b") - 1).alias("n_links"))
    return deals.join(links, [by, "amount"], "left").select("id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def band_pairs(left: DataFrame, right: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Pairs (a, b) of left (a, amount_a) and right (b, amount_b) whose amounts match.

    Amounts that match are found once for all rows that have them, by an equi-join on logarithmic buckets; rows then join by equality
    of amounts. So every pair that is made is a result, and tasks share the pairs by right amounts, which are many more than buckets.
    Rows with negative amounts have no pairs here.
    """
    l, r = left.where("amount_a >= 0").select("a", "amount_a"), right.where("amount_b >= 0").select("b", "amount_b")  # noqa: E741
    of_a = l.select("amount_a").distinct().withColumn("bucket", _bucket(F.col("amount_a"), tolerance))
    of_b = r.select("amount_b").distinct().withColumn("bucket", _around(_bucket(F.col("amount_b"), tolerance)))
    match = of_a.join(of_b, "bucket").where(amounts_match(F.col("amount_a"), F.col("amount_b"), tolerance)).select("amount_a", "amount_b")
    # by sorting: a broadcast of r would leave all its pairs to the few tasks that read l
    return l.join(match, "amount_a").select("a", "amount_b").join(r.hint("merge"), "amount_b").select("a", "b")


NEEDLES, NEEDLE_BYTES = 1000, 1 << 20


def contains_pairs(names: DataFrame, needles: DataFrame, any_case: bool = True, most: int = NEEDLES) -> DataFrame:
    """Pairs (id, needle) where names.name contains the needle, in any case or as it is spelt.

    At most `most` needles, in NEEDLE_BYTES, are broadcast (both counted before). More are joined by equality with those parts of a
    name that are as long as some needle. Null names and needles have no pairs; an empty needle is in every name.
    """
    fold = F.upper if any_case else (lambda c: c)
    known = needles.where(F.col("needle").isNotNull()).withColumn("_key", fold(F.col("needle")))
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("needle")), F.lit(0)).alias("size")).first()
    own = names.withColumn("_name", fold(F.col("name")))
    if size.n <= most and size.size <= NEEDLE_BYTES:
        return own.join(F.broadcast(known), F.contains("_name", "_key")).select("id", "needle")
    lengths = known.agg(F.collect_set(F.length("_key")).alias("lengths"))  # one row; as many values as needles have lengths
    n = F.length("_name")
    of_length = lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr("_name", i, k))
    parts = F.array_distinct(F.flatten(F.transform(F.filter("lengths", lambda k: k <= n), of_length)))
    return own.crossJoin(F.broadcast(lengths)).select("id", F.explode(parts).alias("_key")).join(known, "_key").select("id", "needle")


def containing(deals: DataFrame, pages: DataFrame, column: str, kind: str, most: int = NEEDLES) -> DataFrame:
    """Deals (id, company) with the least page_id, and the number, of pages of a type whose `column` contains the company as it is spelt.

    The existence check before a page is made. Companies are taken once however many deals they have. Deals of an empty or null company
    have no page.
    """
    companies = deals.where("company <> ''").select(F.col("company").alias("needle")).distinct()
    entries = pages.where(F.col("type") == kind).select(F.col("page_id").alias("id"), F.col(column).alias("name"))
    found = contains_pairs(entries, companies, False, most).groupBy(F.col("needle").alias("company")).agg(F.min("id").alias("page_id"), F.count("*").alias("n_pages"))
    return deals.select("id", "company").join(found, "company", "left").select("id", "page_id", F.coalesce("n_pages", F.lit(0)).alias("n_pages"))


def missing(deals: DataFrame, pages: DataFrame, on: list[str]) -> DataFrame:
    return deals.join(pages.select(*on).distinct(), on, "left_anti")


def present(deals: DataFrame, pages: DataFrame, on: list[str]) -> DataFrame:
    return deals.join(pages.select(*on).distinct(), on, "left_semi")


def canonical_pick(pages: DataFrame, by: str, order: list[Column]) -> DataFrame:
    """The first row of each cluster in the given total order (nulls first): a minimum, which every task takes of its own rows first.

    All columns that pages has travel with the row: give it those that are wanted.
    """
    names = [c for c in pages.columns if c != by]
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    best = pages.groupBy(by).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return best.select(by, *(F.col(f"_row.`{c}`") for c in names)).select(*(F.col(f"`{c}`") for c in pages.columns))


def zero_amount_guard(deals: DataFrame, pages: DataFrame) -> DataFrame:
    """Deals (id, company, amount) with an action: an unknown amount reuses the company's page, or makes a flagged one."""
    known = pages.groupBy("company").agg(F.min("page_id").alias("page_id"))
    unknown = F.coalesce("amount", F.lit(0)) == 0
    out = deals.join(known, "company", "left").withColumn("page_id", F.when(unknown, F.col("page_id")))
    return out.select("id", F.when(~unknown, "key").when(F.col("page_id").isNotNull(), "reuse").otherwise("flag").alias("action"), "page_id")


def greedy_dedup(deals: DataFrame, by: str, tolerance: float = 0.05) -> DataFrame:
    """Deals (id, seen_at, amount) with the id of their canonical: the first one of `by`, in order of time, that they match.

    Matching isn't transitive, so the order matters. Records of one amount share a canonical: what the first of them found is
    still the first match for the others. So the fold takes an amount once, whatever its number of records. Amounts in order with
    a gap over the tolerance between them can't match across it, so each run between two gaps is folded on its own, and holds its
    canonicals alone, which no two match. An unknown amount matches nothing. A null `by` is a group like others.
    """
    known = deals.where("amount is not null").groupBy(by, "amount").agg(F.min(F.struct("seen_at", "id")).alias("first"))
    ordered = Window.partitionBy(by).orderBy("amount")
    gap = ~F.coalesce(amounts_match(F.lag("amount").over(ordered), F.col("amount"), tolerance), F.lit(False))
    known = known.withColumn("gap", gap.cast("int")).withColumn("run", F.sum("gap").over(ordered))
    rows = F.array_sort(F.collect_list(F.struct("first.seen_at", "first.id", "amount")))
    empty = F.array().cast("array<struct<id:bigint,amount:bigint>>")

    def found(canon: Column, amount: Column) -> Column:
        return F.get(F.filter(canon, lambda c: amounts_match(c["amount"], amount, tolerance)), F.lit(0))

    def step(canon: Column, x: Column) -> Column:
        new = F.array(F.struct(x["id"].alias("id"), x["amount"].alias("amount")))
        return F.when(found(canon, x["amount"]).isNull(), F.concat(canon, new)).otherwise(canon)

    folded = known.groupBy(by, "run").agg(rows.alias("rows")).select(by, "rows", F.aggregate("rows", empty, step).alias("canon"))
    each = F.transform("rows", lambda x: F.struct(x["amount"].alias("of"), found(F.col("canon"), x["amount"])["id"].alias("canonical")))
    named = folded.select(F.col(by).alias("owner"), F.explode(each).alias("x")).select("owner", "x.*")
    out = deals.join(named, F.col(by).eqNullSafe(F.col("owner")) & (F.col("amount") == F.col("of")), "left")
    return out.select(by, "id", F.coalesce("canonical", "id").alias("canonical_id"))
