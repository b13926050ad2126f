"""Mixing sources to target weights by temperature, in DataFrame and SQL functions only.

A source's weight is its share of tokens to the power of an exponent, normalised. The exponent is bisected: the least that
keeps every source's repetitions within `max_repeats` or, with `target_entropy`, one that meets that entropy (in nats) if
it isn't less than that. The budget is the number of tokens of the mix; by default the least at which no source is cut.

A source's share of the budget is so many epochs of it. Its documents lie in blocks by a hash (a power of two of them, that grows with
the root of their number); each epoch visits the blocks in a permutation of its own (multiplication by an odd number and a shift). All
but the last epoch are whole; the last takes blocks in that order while their tokens fit, and in the block where they
stop, documents in hash order. That stop is one row per source, so no document is joined with another and a source with a
third of all rows is one row of a small plan. `mix_order` says where a copy stands, so that a reader in that order gets the
sources in their weights all along.

Sources may be many: without a budget and an entropy the exponent follows from the least and the largest share; otherwise each
halving needs sums over all sources, of which SECTION exponents are taken at once. Nothing is gathered but such sums. A budget that
no exponent meets within `max_repeats` is a ValueError. Columns of the input named n_tokens, epoch, weight or mix_order are replaced.

Nulls: a null source is a source; a null text has no tokens. Documents without tokens are free and come once. Repeated rows
are taken or left together. Ties in a block's order are settled by the row's own key. An empty table gives no rows. A very long text is
one row. Other columns stay, whatever their names, but for the four above.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsieve.llm.common import KEY, cut, row_key

MAX_REPEATS = 2.0
SECTION = 64
"""Exponents that one pass over the sources tries: six halvings."""
BLOCK_DOCS = 64
SEED = 17
BROADCAST_BYTES = 16 << 20


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _bisect(top: float, fits: Callable[[list[float]], list[bool]], rounds: int) -> float:
    """The least exponent in (0, top] that fits, all above it fitting too; so many rounds of SECTION parts."""
    low, high = 0.0, top
    for _ in range(rounds):
        tried = [low + (high - low) * i / SECTION for i in range(1, SECTION)]
        n = sum(not x for x in fits(tried))
        low, high = [low, *tried][n], [*tried, high][n]
    return high


def exponent(stats: DataFrame, budget: float | None, max_repeats: float, target_entropy: float | None) -> float:
    """The exponent for the rows (source, t) with t > 0."""
    used = stats.where("t > 0")
    r = used.agg(F.sum("t").cast("double").alias("total"), F.min("t").cast("double").alias("low"), F.max("t").cast("double").alias("high")).first()
    if not r.total:
        return 1.0

    def sums(ms: list[float]) -> list[tuple[float, float]]:
        """For each exponent: the sum of the powers of all shares, and that of powers times logarithms."""
        p = F.col("t") / F.lit(r.total)
        x = used.agg(*(f(F.pow(p, F.lit(m))).alias(f"{n}{i}") for i, m in enumerate(ms) for n, f in (("z", F.sum), ("l", lambda c: F.sum(c * F.log(p)))))).first()
        return [(x[f"z{i}"], x[f"l{i}"]) for i in range(len(ms))]

    least = lambda m: (r.low / r.total) ** (m - 1)  # noqa: E731  the repeats of the smallest source, before normalising
    if budget is None:
        found = _bisect(1.0, lambda ms: [least(m) / (r.high / r.total) ** (m - 1) <= max_repeats for m in ms], 10)
    else:
        if budget / r.total > max_repeats:
            raise ValueError(f"a budget of {budget} tokens needs {budget / r.total:.3f} repeats of {r.total:.0f} tokens, {max_repeats} are allowed")
        found = 0.0 if budget / r.total * least(0.0) / sums([0.0])[0][0] <= max_repeats else _bisect(1.0, lambda ms: [budget / r.total * least(m) / z <= max_repeats for m, (z, _) in zip(ms, sums(ms))], 8)
    if target_entropy is not None:
        found = max(found, _bisect(16.0, lambda ms: [math.log(z) - m * w / z <= target_entropy for m, (z, w) in zip(ms, sums(ms))], 8))
    return found


def _blocks(n: Column) -> Column:
    """A power of two: about a block for each BLOCK_DOCS documents, and at most some times their number's root, as one task each
    reads a source's blocks and the documents of one block."""
    power = lambda x: F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(x, F.lit(1.0)))))
    return F.least(power(n / BLOCK_DOCS), power(8 * F.sqrt(n))).cast("long")


def _place(epoch: Column) -> Column:
    """Where the block stands in the epoch's permutation of its source's blocks."""
    mixed = F.xxhash64(F.lit(SEED), F.col("source"), epoch)
    odd, shift = F.shiftleft(F.pmod(mixed, F.lit(1 << 20)), 1) + 1, F.pmod(F.shiftright(mixed, 21), F.lit(1 << 20))
    return F.pmod(F.col("block") * odd + shift, F.col("n_blocks"))


def plan(rows: DataFrame, budget: float | None = None, max_repeats: float = MAX_REPEATS, target_entropy: float | None = None) -> DataFrame:
    """Per source: its share, weight, epochs, and where its last epoch stops. rows: source, n_tokens, _k1, _k2."""
    stats = cut(rows.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")))
    power = exponent(stats, budget, max_repeats, target_entropy)
    raw = F.when(F.col("t") > 0, F.pow(F.col("t") / F.lit(float(stats.agg(F.sum("t")).first()[0] or 1)), F.lit(power))).otherwise(F.lit(0.0))
    shares = stats.withColumn("raw", raw)
    totals = shares.agg(F.sum("raw").alias("z"), F.max(F.when(F.col("raw") > 0, F.col("t") / F.col("raw"))).alias("most"), F.sum("t").alias("all")).first()
    z, most, total = float(totals.z or 1.0), float(totals.most or 0.0), float(totals["all"] or 1)
    size = float(budget) if budget is not None else most * z
    epochs = F.when(F.col("t") > 0, F.round(F.col("raw") / z * size / F.col("t"), 9)).otherwise(F.lit(0.0))
    out = shares.select("source", "t", "n", (F.col("t") / total).alias("share"), (F.col("raw") / z).alias("weight"), epochs.alias("epochs"), _blocks(F.col("n")).alias("n_blocks"), F.lit(power).alias("exponent"))
    out = cut(out.withColumn("whole", F.floor("epochs").cast("int")).withColumn("part", F.floor((F.col("epochs") - F.col("whole")) * F.col("t")).cast("long")))

    placed = _with_blocks(rows.where("n_tokens > 0"), out.where("part > 0")).withColumn("place", _place(F.col("whole")))
    sums = placed.groupBy("source", "place", "part").agg(F.sum("n_tokens").alias("s"))
    before = F.sum("s").over(Window.partitionBy("source").orderBy("place")) - F.col("s")
    # a source has as many sums as blocks; the edge is the block in which the part is used up
    edge = cut(sums.withColumn("before", before).where("before <= part and before + s > part").select("source", F.col("place").alias("edge"), (F.col("part") - F.col("before")).alias("left")))
    order = F.struct("h", *KEY)
    at_edge = placed.join(edge, placed.source.eqNullSafe(edge.source) & (placed.place == edge.edge)).select(placed.source, "h", *KEY, "n_tokens", "left")
    run = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("h", *KEY))
    stop = at_edge.withColumn("run", run).where("run <= left").groupBy("source").agg(F.max(order).alias("stop"))
    e, s = edge.select(F.col("source").alias("es"), "edge"), stop.select(F.col("source").alias("ss"), "stop")
    return cut(out.join(e, out.source.eqNullSafe(e.es), "left").join(s, out.source.eqNullSafe(s.ss), "left").drop("es", "ss"))


def _with_blocks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with their source's plan, block, and hash in it. The plan is broadcast if it is small: its bytes are summed up before."""
    p = sources.withColumnRenamed("source", "_source")
    width = 16 * len(p.columns)  # of a row without its source's name, about
    small = p.agg(F.coalesce(F.sum(F.coalesce(F.octet_length(F.col("_source").cast("string")), F.lit(0)) + width), F.lit(0))).first()[0] <= BROADCAST_BYTES
    h = F.xxhash64(F.lit(SEED), *KEY)
    joined = rows.join(F.broadcast(p) if small else p, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return joined.withColumn("h", F.shiftrightunsigned(h, 1)).withColumn("block", F.pmod(h, F.col("n_blocks")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", budget: float | None = None, max_repeats: float = MAX_REPEATS, target_entropy: float | None = None) -> DataFrame:
    """docs' columns, and per copy: n_tokens, epoch, weight, mix_order. A document comes once per epoch that takes it."""
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(source_col).alias("source"), tokens(F.col(text_col)).alias("n_tokens"), *row_key(id_col, text_col))
    light = cut(rows.select("source", "n_tokens", *KEY))
    found = plan(light, budget, max_repeats, target_entropy)
    out = _with_blocks(rows, found)
    last = _place(F.col("whole"))
    taken = (F.col("part") > 0) & (F.col("edge").isNull() | (last < F.col("edge")) | ((last == F.col("edge")) & F.coalesce(F.struct("h", *KEY) <= F.col("stop"), F.lit(False))))
    copies = F.when(F.col("n_tokens") == 0, 1).otherwise(F.col("whole") + taken.cast("int"))
    out = out.withColumn("copies", copies).where("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    within = (_place(F.col("epoch")) + F.col("h") / F.lit(float(1 << 63))) / F.col("n_blocks")
    order = (F.col("epoch") + within) / F.greatest(F.col("epochs"), F.lit(1.0))
    added = {"n_tokens": F.col("n_tokens"), "epoch": F.col("epoch"), "weight": F.col("weight"), "mix_order": order}
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in names if c not in added), *(c.alias(x) for x, c in added.items()))
