"""Lookups by beginnings of keys, and names that differ by few characters: as range and equality joins, counted and not listed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsieve.sources.staging import cut


def starting_with(prefixes: DataFrame, keys: DataFrame) -> DataFrame:
    """(prefix, n_keys): for each distinct prefix, how many rows of keys (key) start with it.

    Keys that start with p lie, in the order of their bytes, from p on and before p followed by a byte that UTF-8 doesn't have. So keys,
    lower and upper bounds are sorted together by ranges, and the keys up to each bound are counted within its range; the ranges'
    totals, a row for each range, are added up on their own. Equal keys, and equal prefixes, are one row before. Null keys and
    prefixes have no part; the empty prefix starts all keys.
    """
    bound = lambda side: F.when(side == 0, F.encode("prefix", "utf-8")).otherwise(F.concat(F.encode("prefix", "utf-8"), F.unhex(F.lit("FF"))))
    own = prefixes.where("prefix is not null").select("prefix").distinct()
    points = own.select("prefix", F.explode(F.array(F.lit(0), F.lit(2))).alias("side")).select("prefix", "side", bound(F.col("side")).alias("at"), F.lit(0).cast("long").alias("n"))
    known = keys.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).select(F.lit(None).cast("string").alias("prefix"), F.lit(1).alias("side"), F.encode("key", "utf-8").alias("at"), "n")
    rows = cut(points.unionByName(known).repartitionByRange("at").withColumn("range", F.spark_partition_id()))
    totals = rows.groupBy("range").agg(F.sum("n").alias("total"))
    before = totals.select("range", (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("before"))  # as many rows as ranges
    here = F.sum("n").over(Window.partitionBy("range").orderBy("at", "side"))
    counted = rows.withColumn("here", here).where("side <> 1").join(F.broadcast(before), "range")
    return counted.groupBy("prefix").agg(F.sum(F.when(F.col("side") == 2, F.col("before") + F.col("here")).otherwise(-F.col("before") - F.col("here"))).alias("n_keys"))


def _shortened(name: Column, most: int) -> Column:
    """name, and all that is left of it after up to `most` characters are taken out."""
    out = F.array(name)
    for _ in range(most):
        n = lambda x: F.length(x)
        one = lambda x: F.transform(F.sequence(F.lit(1), n(x)), lambda i: F.concat(F.substr(x, F.lit(1), i - 1), F.substr(x, i + 1, n(x))))
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(F.filter(out, lambda x: n(x) > 0), one))))
    return out


def _one_apart(classes: DataFrame) -> DataFrame:
    """(name, near, rows): for distinct names (name, n_rows), parts of the number of names at a distance of 1, and of those names' rows.

    Names of one length differ at one place i exactly where they are equal without their character i, so each such pair meets at
    one i, and what meets there is counted as a whole. A longer name meets a shorter one where the shorter is left of it, once.
    """
    places = F.sequence(F.lit(1), F.length("name"))
    without = lambda i: F.concat(F.substr(F.col("name"), F.lit(1), i - 1), F.substr(F.col("name"), i + 1, F.length("name")))
    each = classes.where("name <> ''").select("name", "n_rows", F.explode(F.transform(places, lambda i: F.struct(i.alias("i"), without(i).alias("rest")))).alias("x"))
    here = Window.partitionBy("x.i", "x.rest")
    same = each.withColumns({"near": F.count("*").over(here) - 1, "rows": F.sum("n_rows").over(here) - F.col("n_rows")}).where("near > 0").select("name", "near", "rows")
    longer = classes.where("name <> ''").select(F.col("name").alias("long"), F.col("n_rows").alias("long_rows"), F.explode(F.array_distinct(F.transform(places, without))).alias("name"))
    # a row for each length that names have: no others are looked for
    lengths = classes.select(F.length("name").alias("length")).distinct()
    found = longer.join(F.broadcast(lengths), F.length("name") == F.col("length")).join(classes.hint("merge"), "name")
    one = lambda name, rows: F.struct(F.col(name).alias("name"), F.lit(1).cast("long").alias("near"), F.col(rows).alias("rows"))
    return same.unionByName(found.select(F.inline(F.array(one("name", "long_rows"), one("long", "n_rows")))))


def near_names(rows: DataFrame, name: str, most: int = 1) -> DataFrame:
    """(name, n_rows, n_near, n_near_rows): for each distinct name, its rows, how many other names are at an edit distance of at most `most`,
    and those names' rows.

    Two such names have a string in common after at most `most` characters are taken out of each: names join by equality of what is
    left, and the distance decides. A name is taken once however many rows have it. Names with one string in common are names that
    arise from it by `most` insertions: their number has a bound that doesn't grow with the rows. At a distance of 1 pairs aren't
    listed at all. Joins are by sorting: what is taken out of names makes tables much larger than Spark expects them to be, and it would
    broadcast them. Null names have no part.
    """
    classes = cut(rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n_rows")))
    if most == 1:
        parts = _one_apart(classes)
    else:
        left = classes.select("name", "n_rows", F.explode(_shortened(F.col("name"), most)).alias("rest"))
        other = left.select(F.col("name").alias("other"), F.col("n_rows").alias("other_rows"), "rest")
        pairs = left.join(other.hint("merge"), "rest").where((F.col("name") != F.col("other")) & (F.levenshtein("name", "other") <= most)).select("name", "other", "other_rows").distinct()
        parts = pairs.select("name", F.lit(1).alias("near"), F.col("other_rows").alias("rows"))
    near = parts.groupBy("name").agg(F.sum("near").alias("n_near"), F.sum("rows").alias("n_near_rows"))
    return classes.join(near.hint("merge"), "name", "left").select("name", "n_rows", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.coalesce("n_near_rows", F.lit(0)).alias("n_near_rows"))
