"""Page quality: the rule set, its status lattice, and the template check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsieve.functions.text import bullets, contains_any_case, error_hits, occurrences, section, section_literal, strip
from recsieve.sources.staging import cut
from recsieve.sources.stored import StoredTable

# Markers, sections and messages.
OUTREACH = ("[[OUTREACH_INTEL_AUTO_START]]", "[[OUTREACH_INTEL_AUTO_END]]")
HIRING = ("[[HIRING_INTEL_AUTO_START]]", "[[HIRING_INTEL_AUTO_END]]")
SECTIONS = [("DEAL SUMMARY", True, None), ("INVESTORS", True, None), ("SOURCES", True, None), ("OUTREACH INTEL (AUTO)", False, OUTREACH), ("HIRING INTELLIGENCE", False, HIRING)]
INTEL, PACK = "FUNDRAISING INTEL", "SIGNAL PACK"
STATUSES = ["PASS", "WARN", "FAIL", "SKIP"]


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def archived(entry: Column) -> Column:
    return F.upper(F.coalesce(entry, F.lit(""))).contains("[ARCHIVED")


def facts(mode: str = "literal") -> dict[str, Column]:
    """What the rules ask of a page's content, and of that in upper case (`_up`). They are computed in a projection of their own, once
    for each page, and only for the types of pages whose rules ask for them; they are null for others."""
    content, up, kind = _text("content"), F.col("_up"), _text("type")
    investors = section_literal(content, "INVESTORS", up) if mode == "literal" else section(content, "INVESTORS")
    marks = {"outreach_start": OUTREACH[0], "outreach_end": OUTREACH[1], "hiring_start": HIRING[0], "hiring_end": HIRING[1], "noise": "mcp_unavailable"}
    intel = {"investors": investors, **{n: occurrences(content, m) for n, m in marks.items()}}
    pack = {"snapshot": contains_any_case(content, "MARKET SNAPSHOT", up), "signal": contains_any_case(content, "SIGNAL", up)}
    return {
        "hits": F.slice(error_hits(content, up), 1, 3), "size": F.when(kind.isin(INTEL, PACK), F.length(strip(content))),
        **{n: F.when(kind == INTEL, c) for n, c in intel.items()}, **{n: F.when(kind == PACK, c) for n, c in pack.items()},
    }


def qa_rules(mode: str = "literal") -> list[tuple[str, Column, Column]]:
    """(severity, condition, message) in the order in which issues are given. Columns: report_key, type, source_skill, run_id and the facts."""
    kind, say = _text("type"), F.lit
    intel, pack = kind == INTEL, kind == PACK
    fact = {name: F.col(f"_fact_{name}") for name in facts(mode)}
    starts, ends = {n: fact[f"{n}_start"] for n in ("outreach", "hiring")}, {n: fact[f"{n}_end"] for n in ("outreach", "hiring")}
    hits, noise, size, n = fact["hits"], fact["noise"], fact["size"], bullets(fact["investors"])
    listed = F.coalesce(fact["investors"], F.lit("")) != ""
    return [
        ("FAIL", _text("report_key") == "", say("Empty REPORT KEY — page is invisible to dedup system.")),
        ("FAIL", F.size(hits) > 0, F.concat(say("Error text in body: "), F.array_join(hits, ", "))),
        ("FAIL", intel & ((starts["outreach"] > 0) != (ends["outreach"] > 0)), say("Unpaired outreach markers — START without END or vice versa.")),
        ("FAIL", intel & ((starts["hiring"] > 0) != (ends["hiring"] > 0)), say("Unpaired hiring markers — START without END or vice versa.")),
        ("WARN", intel & (starts["outreach"] == 0), say("Missing outreach enrichment section (no markers found).")),
        ("WARN", intel & (starts["hiring"] == 0), say("Missing hiring intelligence section (no markers found).")),
        ("FAIL", intel & (starts["outreach"] > 1), F.concat(say("Stacked outreach sections: "), starts["outreach"].cast("string"), say(" START markers found."))),
        ("FAIL", intel & (starts["hiring"] > 1), F.concat(say("Stacked hiring sections: "), starts["hiring"].cast("string"), say(" START markers found."))),
        ("WARN", intel & listed & (n == 0), say("No investors listed.")),
        ("WARN", intel & listed & (n > 0) & (n < 3), F.concat(say("Only "), n.cast("string"), say(" investor(s) listed — verify completeness."))),
        ("WARN", intel & (noise > 0), F.concat(say("Icebreaker MCP unavailable ("), noise.cast("string"), say(" entries) — warm intro map is placeholder only."))),
        ("WARN", intel & (size < 500), say("Page content is very thin (<500 chars) — likely a bare skeleton.")),
        ("WARN", pack & ~fact["snapshot"], say("Missing expected section: MARKET SNAPSHOT")),
        ("WARN", pack & ~fact["signal"], say("Missing expected section: SIGNAL")),
        ("WARN", pack & (size < 300), say("Signal Pack content is very thin (<300 chars).")),
        ("WARN", _text("source_skill") == "", say("Empty SOURCE SKILL — pipeline traceability lost.")),
        ("WARN", _text("run_id") == "", say("Empty RUN ID — cannot trace to specific pipeline run.")),
    ]


def validate_pages(pages: DataFrame, mode: str = "literal") -> DataFrame:
    """pages with qa_status (PASS, WARN, FAIL, or SKIP for archived ones) and qa_issues (at most 2,000 characters).

    The status depends on the rules' conditions alone: where only it is asked for, no message is put together.
    """
    rules, gone = qa_rules(mode), archived(F.col("entry"))
    any_of = lambda kinds: F.coalesce(reduce(lambda a, b: a | b, (F.coalesce(cond, F.lit(False)) for sev, cond, _ in rules if sev in kinds)), F.lit(False))
    out = pages.withColumn("_up", F.upper(_text("content"))).withColumns({f"_fact_{n}": c for n, c in facts(mode).items()})
    out = out.withColumns({"_gone": gone, "_failed": any_of(["FAIL"]), "_found": any_of(["FAIL", "WARN"])})
    status = F.when(F.col("_gone"), "SKIP").when(F.col("_failed"), "FAIL").when(F.col("_found"), "WARN").otherwise("PASS")
    said = F.substring(F.concat_ws(" | ", *(F.when(cond, msg) for _, cond, msg in rules)), 1, 2000)
    issues = F.when(F.col("_gone"), "").when(~F.col("_found"), "All checks passed.").otherwise(said)
    return out.withColumns({"qa_status": status, "qa_issues": issues}).drop("_up", "_gone", "_failed", "_found", *(f"_fact_{n}" for n in facts(mode)))


def status_histogram(validated: DataFrame) -> DataFrame:
    """A count for each of the four statuses, zeros too."""
    domain = validated.sparkSession.createDataFrame([(s,) for s in STATUSES], "qa_status string")
    counts = validated.groupBy("qa_status").agg(F.count("*").alias("n"))
    return F.broadcast(domain).join(counts, "qa_status", "left").select("qa_status", F.coalesce("n", F.lit(0)).alias("n_pages"))


def status_json(histogram: DataFrame) -> DataFrame:
    """One row: the histogram as a JSON object, statuses in their usual order."""
    n = [F.coalesce(F.sum(F.when(F.col("qa_status") == s, F.col("n_pages"))), F.lit(0)).alias(s) for s in STATUSES]
    return histogram.agg(*n).select(F.to_json(F.struct(*STATUSES)).alias("stats"))


def audited(pages: DataFrame, now: Column, mode: str = "literal") -> DataFrame:
    """pages after a write-back: qa_status, qa_issues and last_audited_at are new, but for archived pages, which keep theirs.

    Columns of these names that pages lack are null before. A null status of before stays null for archived pages.
    """
    old = {c: F.col(c) if c in pages.columns else F.lit(None) for c in ("qa_status", "qa_issues", "last_audited_at")}
    kept = pages.withColumns({f"_old_{c}": x for c, x in old.items()}).drop(*old)
    out = validate_pages(kept, mode).withColumn("_skip", F.col("qa_status") == "SKIP")
    new = {"qa_status": F.col("qa_status"), "qa_issues": F.col("qa_issues"), "last_audited_at": now}
    kinds = {"qa_status": "string", "qa_issues": "string", "last_audited_at": "timestamp"}
    out = out.withColumns({c: F.when(F.col("_skip"), F.col(f"_old_{c}").cast(kinds[c])).otherwise(x) for c, x in new.items()})
    names = [*pages.columns, *(c for c in old if c not in pages.columns)]
    return out.select(*(F.col(f"`{c}`") for c in names))


def post_write_hook(pages: DataFrame, page_id: object, mode: str = "literal") -> str | None:
    """The status of one page after it was written; null if there is no such page."""
    found = validate_pages(pages.where(F.col("page_id") == F.lit(page_id)), mode).select("qa_status").first()
    return found and found.qa_status


def audit_written(table: StoredTable, page_ids: DataFrame, now: Column, mode: str = "literal") -> DataFrame:
    """(page_id, qa_status) of pages of a stored table (keyed by page_id) that were just written: checked, and the result written back to them.

    Pages that aren't there have no row; archived ones keep the status they had. Nothing but these pages' statuses changes.
    """
    written = table.read().join(page_ids.select("page_id").distinct(), "page_id", "left_semi")
    checked = audited(written, now, mode).select("page_id", "qa_status", "qa_issues", "last_audited_at")
    statuses = cut(checked)
    table.upsert(statuses)
    return statuses.select("page_id", "qa_status")


def structure_issues(content: Column, up: Column | None = None) -> Column:
    """What a page lacks of the template, in the template's order. up: the content in upper case, if the caller has it."""
    c, out = F.coalesce(content, F.lit("")), []
    for heading, required, markers in SECTIONS:
        if required:
            out.append(F.when(~contains_any_case(c, heading, up), F.lit(f"Missing required section: {heading}")))
        if markers:
            n = occurrences(c, markers[0])
            out.append(F.when(n == 0, F.lit(f"Missing start marker for {heading}: {markers[0]}")))
            out.append(F.when(~F.contains(c, F.lit(markers[1])), F.lit(f"Missing end marker for {heading}: {markers[1]}")))
            out.append(F.when(n > 1, F.concat(F.lit(f"Duplicate markers for {heading}: "), n.cast("string"), F.lit(f" instances of {markers[0]}"))))
    # takes the nulls out without a lambda, so that the whole stays generated code; no two issues are equal
    return F.array_except(F.array(*out), F.array(F.lit(None).cast("string")))
