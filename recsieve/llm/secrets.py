"""Secret scans with an incremental blob ledger, in DataFrame and SQL functions only.

Every version of a text is addressed by the SHA-256 of its content. The ledger has rows of a blob, the rules and rule versions that it
was scanned with, and what they found. Only pairs of blob and rule version that the ledger lacks are scanned, each blob once
however many paths have it, and findings are joined back to all paths. A ledger only grows: a scan appends what is new and
rewrites nothing (scan_into keeps one as a Parquet table). If a scan is given twice, or its rows were appended twice, equal findings
count once.

Nulls: a null text is empty; a null path is a path like others. Ties: spans of one start are in the rules' order. Repeated rows get
equal results. Empty tables give empty ones. A very long text is scanned whole, as one row. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsieve.llm.common import KEY, cut, let, merged, row_key, running


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if group `group` has `least` characters or more. `hint`: text that any match has."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hint: str = ""

    @property
    def plain(self) -> str:
        """The pattern for engines without possessive loops."""
        return self.pattern.replace("*+", "*").replace("++", "+")

    @property
    def version(self) -> str:
        return hashlib.sha256(repr(self).encode()).hexdigest()[:16]


BASE = (
    Rule("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
# A key block runs to its END line, with dashes of its own (header fields, a diff's minus signs) but no five in a row. Without an END
# line it runs over header fields and all pieces of 16 base64 characters or more that stand in a row, whatever leads or parts them (white
# space, `\n` for newlines, quotes, signs of diffs and comments), and over a shorter line after each; without such pieces it is the
# BEGIN line. There are no counts: a key of any length goes. Loops are possessive, so that they take no stack for each line; in the
# SQL, whose engine has no such loops and needs no stack, they are plain ones.
_BASE64 = r"[A-Za-z0-9+/=]"
_BETWEEN = r"""(?:\\[nrt]|[\r\n\x20\t"',;:>|*#-]|[+/]{1,2}[\x20\t])"""
_NEWLINE = r"(?:[\r\n]|\\[nr])"
_SHORT = rf"""(?:[\x20\t"',;]*+{_NEWLINE}{_BETWEEN}*+{_BASE64}{{1,15}}[\x20\t"',;]*+(?:{_NEWLINE}|\z))?"""
PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-{1,4}[^-]++)*+-{5,}END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_BETWEEN}++[A-Za-z][A-Za-z0-9-]*+:\x20[^\r\n\\]*+)*+(?:{_BETWEEN}*+{_BASE64}{{16}}{_BASE64}*+{_SHORT})++|)"
)
MORE = (
    Rule("pem", PEM, hint="-----BEGIN "),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
)
RULES = BASE + MORE
SPANS = "array<struct<start:int,`end`:int>>"
FOUND = f"array<struct<rule:string,version:string,spans:{SPANS}>>"
LEDGER = f"blob binary, found {FOUND}"


def spans(text: Column, rule: Rule) -> Column:
    """Where the rule's leftmost non-overlapping matches are, in code points, end exclusive.

    The pieces between matches and the matches alternate: a match ends where the lengths so far add up to.
    """
    # a run of one class: the first `least` characters can be asked for in the pattern itself, which gives the same matches
    pattern = rule.pattern[:-1] + f"{{{rule.least},}}" if rule.pattern == "[0-9a-f]+" else rule.pattern
    sizes = lambda x: F.transform(x, F.length)
    matches = sizes(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    values = sizes(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))) if rule.group else None

    def place(size: Column, gap: Column, value: Column) -> Column:
        ends = running(F.transform(size, lambda x, i: (F.get(gap, i) + x).cast("long")), lambda a, x: F.coalesce(a, F.lit(0)) + x)
        each = let(ends, lambda e: F.transform(size, lambda x, i: F.struct((F.get(e, i) - x).cast("int").alias("start"), F.get(e, i).cast("int").alias("end"), F.get(value, i).alias("value"))))
        return F.transform(F.filter(each, lambda x: x["value"] >= rule.least), lambda x: F.struct(x["start"], x["end"]))

    found = let(matches, lambda m: let(sizes(F.split(text, pattern, -1)), lambda g: place(m, g, m) if values is None else let(values, lambda v: place(m, g, v))))
    there = F.contains(text, F.lit(rule.hint)) if rule.hint else text.rlike(pattern)
    return F.when(there, found.cast(SPANS)).otherwise(F.array().cast(SPANS))


def scan(versions: DataFrame, path_col: str = "doc_id", text_col: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings, ledger): per row of versions path_col, _k1, _k2, blob and found (kind, start, end by start, then by the
    rules' order); and the ledger (blob, found) with what was scanned now."""
    findings, new = _scan(versions, path_col, text_col, ledger, rules)
    return findings, new if ledger is None else ledger.select("blob", "found").unionByName(new)


def scan_into(path: str, versions: DataFrame, path_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """scan() with the ledger that is the Parquet table at `path`, if there is one: what was scanned now is appended to it, and its
    files stay as they are. The findings hold, and the next scan is right, whether or not the append was done before a failure."""
    spark = versions.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    ledger = spark.read.schema(LEDGER).parquet(path) if there else None
    findings, new = _scan(versions, path_col, text_col, ledger, rules)
    new.write.mode("append").parquet(path)
    return findings


def _scan(versions: DataFrame, path_col: str, text_col: str, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> tuple[DataFrame, DataFrame]:
    """(findings, new rows of the ledger)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = versions.select(F.col(path_col).alias("path"), *row_key(path_col, text_col), F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))
    wanted = F.array(*(F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules))
    one = rows.groupBy("blob").agg(F.min(F.struct(*KEY)).alias("one"))
    if ledger is None:
        known = None
        todo = one.select("blob", "one.*", wanted.alias("todo"))
    else:
        # a blob has a row for each scan that brought new rules; only those of the given blobs are looked at
        known = ledger.join(one.select("blob"), "blob", "left_semi").groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("before"))
        seen = F.transform(F.coalesce("before", F.array().cast(FOUND)), lambda x: F.struct(x["rule"].alias("rule"), x["version"].alias("version")))
        todo = one.join(known, "blob", "left").select("blob", "one.*", F.array_except(wanted, seen).alias("todo")).where(F.size("todo") > 0)
    # one of a blob's rows is read: the join's key has the row's own key, so copies don't meet in one place; rows equal in id and text are one
    texts = rows.select("blob", *KEY, "text").join(todo, ["blob", *KEY]).dropDuplicates(["blob", *KEY])
    results = []
    for r in rules:
        pair = F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"))
        results.append(F.when(F.array_contains("todo", pair), F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), spans(F.col("text"), r).alias("spans"))))
    new = cut(texts.select("blob", F.array_compact(F.array(*results)).cast(FOUND).alias("found")))
    if known is None:
        after = new
    else:
        none = F.array().cast(FOUND)
        after = known.join(new, "blob", "full").select("blob", F.concat(F.coalesce("before", none), F.coalesce("found", none)).alias("found"))
    current = {r.kind: (i, r.version) for i, r in enumerate(rules)}
    place = F.create_map(*(F.lit(x) for k, (i, _) in current.items() for x in (k, i)))
    live = F.filter("found", lambda x: F.array_contains(wanted, F.struct(x["rule"].alias("rule"), x["version"].alias("version"))))
    flat = F.flatten(F.transform(live, lambda x: F.transform(x["spans"], lambda s: F.struct(s["start"].alias("start"), place[x["rule"]].alias("place"), s["end"].alias("end"), x["rule"].alias("kind")))))
    ready = after.select("blob", F.transform(F.array_sort(flat), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("found"))
    return rows.select("path", *KEY, "blob").join(ready, "blob", "left").withColumnRenamed("path", path_col), new


def render(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """text with each span, or run of overlapping spans, replaced by the mark.

    Finding a place in a text takes time with its distance from the text's beginning: pieces are cut out of chunks of 512 characters.
    """

    def piece(chunks: Column, a: Column, b: Column) -> Column:
        first = F.shiftright(a, 9)
        near = F.array_join(F.slice(chunks, first + 1, F.shiftright(F.greatest(b - 1, a), 9) - first + 1), "")
        return F.when(b > a, F.substr(near, a.bitwiseAND(511) + 1, b - a)).otherwise("")

    def pieces(chunks: Column, groups: Column, n: Column) -> Column:
        edges = lambda i: (F.coalesce(F.get(groups, i - 1)["end"], F.lit(0)), F.coalesce(F.get(groups, i)["start"], n))
        return F.transform(F.sequence(F.lit(0), F.size(groups)), lambda i: piece(chunks, *edges(i)))

    whole = let(merged(found, False), lambda g: let(F.length(text), lambda n: let(F.regexp_extract_all(text, F.lit("(?s).{1,512}"), F.lit(0)), lambda c: F.array_join(pieces(c, g, n), mark))))
    return F.when(F.size(found) > 0, whole).otherwise(text)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs with secrets replaced in the texts that have any; chars_col, if there, follows the new text."""
    found = scan(docs, id_col, text_col)[0].where(F.size("found") > 0).groupBy(*KEY).agg(F.first("found").alias("found"))
    names = docs.columns
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), *row_key(id_col, text_col)).join(found, KEY, "left")
    has = F.coalesce(F.size("found") > 0, F.lit(False))
    keyed = keyed.withColumn("changed", F.when(has, redacted(F.col(f"row.`{text_col}`"), F.col("found"))))
    new = {text_col: F.coalesce("changed", F.col(f"row.`{text_col}`"))}
    if chars_col in names:
        new[chars_col] = F.when(has, F.length("changed").cast(docs.schema[chars_col].dataType)).otherwise(F.col(f"row.`{chars_col}`"))
    return keyed.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in names))
