"""Chat formatting with a prefix tree: conversations that begin alike share their first turns' text.

A turn is formatted as `### <role>: <text></turn>` and a newline; backslashes, `###`, `</turn>` and colons of roles are escaped
with a backslash, so formatting is reversible. A prefix (first turns) is hot if more than `pack` conversations have it. Each hot
prefix is a pack of its own with one node, its last turn; `path` names the packs of the shorter prefixes, from the first turn on. All
other packs hold conversations with the same longest hot prefix, or without one the same first turn: their turns below it as a tree,
each once, depth first. They are dealt out by the next turn, so those that share more turns stay together. So each distinct prefix
has one node in all, however many conversations have it, and no task holds more than some packs' conversations.

A node has: where it is in its pack, its parent there (-1: the last node of `path`, or none), the position id of its first character
(its distance from the start of its own conversation; the following characters count up), the intervals of the pack that it
attends to besides itself (its ancestors there; besides, it attends to all of the packs in `path`), and the span under the loss mask
(assistants' texts). Characters are code points. A conversation's leaf is -1 if it ends with the path.

Prefixes are told apart by chained MD5 digests. Nulls: a null text or role is empty; a null turn sorts first; rows with a null conv_id
are one conversation. Ties in turn are ordered by role, then text. Repeated rows are turns like others. An empty table gives no packs.
A very long text is a node of its own length. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from recsieve.llm.common import RUN, cut

PACK = 128
ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
CONTROL = re.compile(r"\\|###|</turn>")
TURN = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|:))*): ((?:[^\\<]|\\(?:\\|###|</turn>)|<(?!/turn>))*)</turn>\n")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the text, and what stands after it."""
    return f"### {escape(role).replace(':', chr(92) + ':')}: ", escape(text), "</turn>\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def build(conversations: list[tuple[object, list[tuple[str, str]]]], offset: int = 0) -> dict:
    """A pack of (id, turns): its text, nodes and leaves. Its first characters have the position `offset`."""
    nodes: list[dict] = []
    children: dict[tuple[int, str, str], int] = {}
    texts: list[str] = []
    at, leaves = 0, []
    # sorted by turns, conversations that share a prefix stand together: nodes appear depth first
    for conv, turns in sorted(conversations, key=lambda c: (c[1], str(c[0]))):
        node = -1
        for role, text in turns:
            known = children.get((node, role, text))
            if known is None:
                before, body, after = turn_parts(role, text)
                parent = nodes[node] if node >= 0 else None
                attends = [dict(x) for x in parent["attends"]] if parent else []
                if parent:
                    if attends and attends[-1]["end"] == parent["start"]:
                        attends[-1]["end"] = parent["end"]
                    else:
                        attends.append({"start": parent["start"], "end": parent["end"]})
                size = len(before) + len(body) + len(after)
                loss = role == "assistant"
                nodes.append({
                    "start": at, "end": at + size, "parent": node, "position": parent["position"] + parent["end"] - parent["start"] if parent else offset,
                    "loss_start": at + len(before) if loss else -1, "loss_end": at + len(before) + len(body) if loss else -1, "attends": attends,
                })
                texts += [before, body, after]
                at += size
                known = children[(node, role, text)] = len(nodes) - 1
            node = known
        leaves.append({"conv_id": conv, "leaf": node, "n_turns": len(turns)})
    return {"text": "".join(texts), "nodes": nodes, "conversations": leaves}


SPAN = [("start", pa.int32()), ("end", pa.int32())]
NODE = pa.struct([*SPAN, *((n, pa.int32()) for n in ("parent", "position", "loss_start", "loss_end")), ("attends", pa.list_(pa.struct(SPAN)))])


def turn_size(role: Column, text: Column) -> Column:
    """The length of a formatted turn."""
    marks = lambda c: F.regexp_count(c, F.lit(CONTROL.pattern))
    return F.length(role) + marks(role) + F.regexp_count(role, F.lit(":")) + F.length(text) + marks(text) + sum(map(len, turn_parts("", "")))


def pack_conversations(rows: DataFrame, pack: int = PACK) -> DataFrame:
    """Packs (pack, path, text, nodes, conversations) of the conversations in rows (conv_id, turn, role, text)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    clean = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    convs = convs.select("conv_id", F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))
    # prefixes[d] stands for the first d + 1 turns
    before = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(""))
    chain = lambda a, x: F.concat(a, F.array(F.md5(F.concat_ws(":", before(a), F.length(x["role"]).cast("string"), x["role"], x["text"]))))
    # a fold that appends copies its array each time: pieces of RUN turns are folded, each from the digest that the piece before ended with
    pieces = F.transform(F.sequence(F.lit(0), F.ceil(F.size("turns") / RUN).cast("int") - 1), lambda i: F.slice("turns", i * RUN + 1, F.lit(RUN)))
    from_last = lambda a: F.array(F.coalesce(F.element_at(F.get(a, F.size(a) - 1), -1), F.lit(""))).cast("array<string>")
    piece = lambda a, p: F.concat(a, F.array(F.slice(F.aggregate(p, from_last(a), chain), F.lit(2), F.size(p))))
    convs = convs.withColumn("prefixes", F.flatten(F.aggregate(pieces, F.array().cast("array<array<string>>"), piece)))
    each = convs.select("conv_id", F.posexplode("prefixes").alias("d", "prefix"))
    hot = cut(each.groupBy("prefix").agg(F.count("*").alias("n"), F.max("d").alias("d"), F.min("conv_id").alias("one")).where(F.col("n") > pack))
    size = lambda turns: F.aggregate(turns, F.lit(0), lambda a, x: a + turn_size(x["role"], x["text"]))

    # a hot prefix is written from one of its conversations
    trunk = convs.join(hot.withColumnRenamed("prefix", "pack"), F.col("conv_id") == F.col("one"))
    trunk = trunk.select("pack", F.slice("prefixes", F.lit(1), F.col("d")).alias("path"), size(F.slice("turns", F.lit(1), F.col("d"))).alias("offset"), F.get("turns", F.col("d")).alias("turn"))

    # a prefix of a hot one is hot: the deepest tells how many turns are
    deep = each.join(hot.select("prefix"), "prefix").groupBy("conv_id").agg((F.max("d") + 1).alias("deep")).withColumnRenamed("conv_id", "of")
    placed = convs.join(deep, F.col("conv_id").eqNullSafe(F.col("of")), "left").withColumn("deep", F.coalesce("deep", F.lit(0)))
    placed = placed.select(
        "conv_id", F.slice("turns", F.col("deep") + 1, F.size("turns") - F.col("deep")).alias("turns"), F.slice("prefixes", F.lit(1), F.col("deep")).alias("path"), size(F.slice("turns", F.lit(1), F.col("deep"))).alias("offset"),
        F.get("prefixes", F.greatest(F.col("deep"), F.lit(1)) - 1).alias("root"), (F.col("deep") > 0).alias("hot"), F.xxhash64(F.coalesce(F.get("prefixes", F.col("deep")), F.col("conv_id").cast("string"))).alias("next"),
    )
    # only hot prefixes of more than one pack have a row here; repartition() deals their packs out to tasks of their own
    parts = placed.where("hot").groupBy("root").agg(F.ceil(F.count("*") / pack).cast("int").alias("parts")).where("parts > 1")
    dealt = placed.join(parts, "root", "left").withColumn("part", F.coalesce(F.pmod("next", "parts"), F.lit(0)).cast("int"))
    dealt = dealt.select("root", "part", "path", "offset", "conv_id", "turns").repartition("root", "part")
    out = f"""pack string, path array<string>, text string, nodes array<struct<start:int,`end`:int,parent:int,position:int,loss_start:int,loss_end:int,attends:array<struct<start:int,`end`:int>>>>,
        conversations array<struct<conv_id:{kind},leaf:int,n_turns:int>>"""

    def schema(conv: pa.DataType) -> pa.Schema:
        leaf = pa.struct([("conv_id", conv), ("leaf", pa.int32()), ("n_turns", pa.int32())])
        return pa.schema([("pack", pa.string()), ("path", pa.list_(pa.string())), ("text", pa.string()), ("nodes", pa.list_(NODE)), ("conversations", pa.list_(leaf))])

    id_type = to_arrow_type(rows.schema["conv_id"].dataType)

    def tree(table: pa.Table) -> pa.Table:
        convs = [(c, [(x["role"], x["text"]) for x in t]) for c, t in zip(table.column("conv_id").to_pylist(), table.column("turns").to_pylist())]
        root, part, path, offset = (table.column(c)[0].as_py() for c in ("root", "part", "path", "offset"))
        return pa.Table.from_pylist([{"pack": f"{root}:{part}", "path": path} | build(convs, offset)], schema=schema(id_type))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [{"pack": r["pack"], "path": r["path"]} | build([(None, [(r["turn"]["role"], r["turn"]["text"])])], r["offset"]) | {"conversations": []} for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(made, schema=schema(id_type))

    return trunk.mapInArrow(single, out).unionByName(dealt.groupBy("root", "part").applyInArrow(tree, out))


def unpack(packs: DataFrame) -> DataFrame:
    """Per conversation, read back from the packs: conv_id, turns, loss_text and formatted. packs is read several times: a table, best."""
    kind = packs.schema["conversations"].dataType.elementType["conv_id"].dataType.simpleString()
    conv = to_arrow_type(packs.schema["conversations"].dataType.elementType["conv_id"].dataType)
    leaves, trunk = packs.where(F.size("conversations") > 0), packs.where(F.size("conversations") == 0)
    # a path's text is put together once for all packs below it; packs without a path have a key of their own, which nothing joins
    paths = leaves.where(F.size("path") > 0).select(F.element_at("path", -1).alias("at"), "path").dropDuplicates(["at"]).select("at", F.posexplode("path").alias("d", "pack"))
    turns = paths.join(trunk.select("pack", "text", F.col("nodes")[0].alias("node")), "pack")
    prefix = turns.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("d", "text", "node.loss_start", "node.loss_end"))).alias("prefix"))
    whole = leaves.withColumn("at", F.when(F.size("path") > 0, F.element_at("path", -1)).otherwise(F.col("pack"))).join(prefix, "at", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                text, nodes, out = row["text"], row["nodes"], []
                above = "".join(x["text"] for x in row["prefix"] or ())
                learned = "".join(unescape(x["text"][x["loss_start"] : x["loss_end"]]) for x in row["prefix"] or () if x["loss_start"] >= 0)
                for c in row["conversations"]:
                    leaf = [nodes[c["leaf"]]] if c["leaf"] >= 0 else []
                    formatted = above + "".join(text[x["start"] : x["end"]] for n in leaf for x in [*n["attends"], n])
                    path, at = [], c["leaf"]
                    while at >= 0:
                        path.append(nodes[at])
                        at = nodes[at]["parent"]
                    loss = learned + "".join(unescape(text[n["loss_start"] : n["loss_end"]]) for n in reversed(path) if n["loss_start"] >= 0)
                    out.append({"conv_id": c["conv_id"], "turns": [{"role": r, "text": t} for r, t in parse(formatted)], "loss_text": loss, "formatted": formatted})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("conv_id", conv), ("turns", turn), ("loss_text", pa.string()), ("formatted", pa.string())]))

    return whole.select("text", "nodes", "conversations", "prefix").mapInArrow(run, f"conv_id {kind}, turns array<struct<role:string,text:string>>, loss_text string, formatted string")
