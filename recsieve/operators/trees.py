"""Trees of blocks of any depth: reading order by list ranking.

A tree is walked along a list of two events for each block, its begin and its end: a begin is followed by the begin of the first child
or, without children, by the end; an end by the begin of the next sibling or else by the parent's end. How far an event is from
the list's end follows by pointer doubling: each round joins every event with the one that it points to, so that pointers leap twice as
far, and rounds grow as the logarithm of the longest list. Rows stay as small as they were, however deep a tree is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsieve.sources.staging import cut


def ranked_events(blocks: DataFrame) -> DataFrame:
    """(page_id, block_id, side, distance, reached) of blocks (page_id, block_id, parent_id, pos): side 0 is a block's begin, 1 its end.

    reached: true for blocks below a root of their page (a root has a null parent_id), false below a parent that isn't there, null for
    those of a cycle, which has no end to be far from. Siblings are in order of pos, then block_id. block_id is unique in its page.
    """
    rows = blocks.select("page_id", "block_id", "parent_id", "pos")
    siblings = Window.partitionBy("page_id", "parent_id").orderBy("pos", "block_id")
    rows = rows.withColumn("sibling", F.lead("block_id").over(siblings))
    first = rows.where("parent_id is not null").groupBy(F.col("page_id").alias("p"), F.col("parent_id").alias("b")).agg(F.min_by("block_id", F.struct("pos", "block_id")).alias("child"))
    there = rows.select(F.col("page_id").alias("p2"), F.col("block_id").alias("b2"))
    rows = rows.join(first, rows["page_id"].eqNullSafe(first["p"]) & (rows["block_id"] == first["b"]), "left")
    rows = rows.join(there, rows["page_id"].eqNullSafe(there["p2"]) & (rows["parent_id"] == there["b2"]), "left")
    begin = F.struct(F.lit(0).alias("side"), F.coalesce("child", "block_id").alias("to_block"), F.when(F.col("child").isNotNull(), 0).otherwise(1).alias("to_side"))
    end = F.struct(F.lit(1).alias("side"), F.coalesce("sibling", "b2").alias("to_block"), F.when(F.col("sibling").isNotNull(), 0).when(F.col("b2").isNotNull(), 1).alias("to_side"))
    events = rows.select("page_id", "block_id", F.col("parent_id").isNull().alias("root"), F.explode(F.array(begin, end)).alias("x")).select("page_id", "block_id", "root", "x.*")
    events = cut(events.select("page_id", "block_id", "side", "to_block", "to_side", F.col("to_block").isNotNull().cast("long").alias("distance"), F.when(F.col("to_block").isNull(), F.col("root")).alias("reached")))
    left = events.where("to_block is not null").count()
    while left:
        goal = events.select(F.col("page_id").alias("p"), F.col("block_id").alias("b"), F.col("side").alias("s"), F.col("to_block").alias("t"), F.col("to_side").alias("ts"), F.col("distance").alias("d"), F.col("reached").alias("r"))
        open_ = events.where("to_block is not null")
        leapt = open_.join(goal, open_["page_id"].eqNullSafe(goal["p"]) & (open_["to_block"] == goal["b"]) & (open_["to_side"] == goal["s"])).select("page_id", "block_id", "side", F.col("t").alias("to_block"), F.col("ts").alias("to_side"), (F.col("distance") + F.col("d")).alias("distance"), F.col("r").alias("reached"))
        events = cut(events.where("to_block is null").unionByName(leapt))
        before, left = left, events.where("to_block is not null").count()
        if left == before:  # a list has events at each distance from its end: those left have no end
            break
    return events.select("page_id", "block_id", "side", F.when(F.col("to_block").isNull(), F.col("distance")).alias("distance"), "reached")


def tree_text(blocks: DataFrame, first_page: int | None = None) -> DataFrame:
    """Per page (page_id), the text of a tree of blocks (page_id, block_id, parent_id, pos, text): each block's text, then its children's.

    Lines are in order of pos; a block with a null text has no line of its own, one with an empty text an empty line. A block of which
    all children are without text and children has an empty line for them. With `first_page`, only so many children of a
    nested block are read. Roots have a null parent_id; blocks that no root leads to (unread_blocks() names them) have no part in the text.
    """
    rows = blocks.select("page_id", "block_id", "parent_id", "pos", "text")
    if first_page is not None:
        place = F.row_number().over(Window.partitionBy("page_id", "parent_id").orderBy("pos", "block_id"))
        rows = rows.withColumn("_n", F.when(F.col("parent_id").isNotNull(), place)).where(F.col("_n").isNull() | (F.col("_n") <= first_page)).drop("_n")
    events = ranked_events(rows).where("reached").select(F.col("page_id").alias("p"), F.col("block_id").alias("b"), "side", "distance")
    parents = rows.where("parent_id is not null").select(F.col("page_id").alias("p"), F.col("parent_id").alias("b")).distinct()
    same = lambda a, b: a["page_id"].eqNullSafe(b["p"]) & (a["block_id"] == b["b"])
    known = rows.join(parents.withColumn("parent", F.lit(True)), same(rows, parents), "left").select("page_id", "block_id", "parent_id", "text", F.coalesce("parent", F.lit(False)).alias("parent"))
    silent = known.where("parent_id is not null").groupBy(F.col("page_id").alias("p"), F.col("parent_id").alias("b")).agg(F.bool_and(F.col("text").isNull() & ~F.col("parent")).alias("silent")).where("silent")
    known = known.join(silent, same(known, silent), "left").select("page_id", "block_id", "text", F.coalesce("silent", F.lit(False)).alias("silent"))
    # a block's line stands at its begin, the empty one at its end
    lines = known.join(events, same(known, events)).where("(side = 0 and text is not null) or (side = 1 and silent)").select("page_id", F.struct((-F.col("distance")).alias("at"), F.when(F.col("side") == 0, F.col("text")).otherwise("").alias("line")).alias("x"))
    texts = lines.groupBy(F.col("page_id").alias("p")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "\n").alias("content"))
    pages = blocks.where("parent_id is null").select("page_id").distinct()
    return pages.join(texts, pages["page_id"].eqNullSafe(texts["p"]), "left").select("page_id", F.coalesce("content", F.lit("")).alias("content"))


def unread_blocks(blocks: DataFrame) -> DataFrame:
    """(page_id, block_id, reason) of blocks that no root leads to: `orphan` below a parent that isn't there, `cycle` in or below a cycle."""
    out = ranked_events(blocks).where("side = 0 and not coalesce(reached, false)")
    return out.select("page_id", "block_id", F.when(F.col("reached").isNull(), "cycle").otherwise("orphan").alias("reason"))
