"""Blocks: page text, block cleaning, and the page template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsieve.functions.amounts import format_amount
from recsieve.functions.keys import report_key
from recsieve.functions.text import append_note, error_only, has_dedup_note, sanitize_text, strip
from recsieve.operators.qa import HIRING, OUTREACH


def page_text(blocks: DataFrame, page: str = "page_id", pos: str = "pos", text: str = "text") -> DataFrame:
    """Per page, its blocks' texts in order, joined by newlines."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return blocks.groupBy(page).agg(F.array_join(F.transform(rows, lambda x: x["t"]), "\n").alias("content"))


def text_property(prop: Column) -> Column:
    """The text of a property struct(type, spans: array of struct(plain_text), name): spans joined and stripped for rich_text and title,
    the name for select; empty for other types and for nulls."""
    joined = strip(F.array_join(F.transform(F.coalesce(prop["spans"], F.array().cast("array<struct<plain_text:string>>")), lambda x: F.coalesce(x["plain_text"], F.lit(""))), ""))
    return F.when(prop["type"].isin("rich_text", "title"), joined).when(prop["type"] == "select", F.coalesce(prop["name"], F.lit(""))).otherwise("")


def cleaner_text(blocks: DataFrame, page: str = "page_id", pos: str = "pos", text: str = "text") -> DataFrame:
    """The same, each line with its newline."""
    return page_text(blocks, page, pos, text).withColumn("content", F.concat("content", F.lit("\n")))


def block_actions(blocks: DataFrame, text: str = "text", mode: str = "literal") -> DataFrame:
    """blocks with cleaned text and action: keep, clean or remove. A block without text (null) is kept."""
    t = F.col(text)
    clean = sanitize_text(t, mode)
    action = F.when(t.isNull(), "keep").when(error_only(t), "remove").when(clean == t, "keep").when(strip(clean) == "", "remove").otherwise("clean")
    return blocks.withColumn("action", action).withColumn("cleaned", F.when(F.col("action") == "keep", t).when(F.col("action") == "clean", clean))


def apply_actions(actions: DataFrame, text: str = "text", keep_removed: str | None = None) -> DataFrame:
    """Blocks after block_actions(): cleaned ones with their new text, removed ones gone, or with `keep_removed` marked in a column of that name."""
    names = [c for c in actions.columns if c not in ("action", "cleaned")]
    new = [F.coalesce("cleaned", F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in names]
    if keep_removed:
        return actions.select(*new, (F.col("action") == "remove").alias(keep_removed))
    return actions.where("action <> 'remove'").select(*new)


def moved_notes(pages: DataFrame, now: Column) -> DataFrame:
    """pages (entry, content, qa_issues) with notes on duplicates moved from the content's lines to the issues; n_moved says how many.

    A line with a note leaves the content, all others stay as they are; a page without notes is unchanged.
    """
    lines = F.split(F.coalesce("content", F.lit("")), "\n", -1)
    out = pages.withColumns({"_has": F.coalesce(has_dedup_note(F.col("content")), F.lit(False)), "_lines": lines})
    kept = F.filter("_lines", lambda x: ~has_dedup_note(x))
    out = out.withColumn("n_moved", F.when(F.col("_has"), F.size("_lines") - F.size(kept)).otherwise(0).cast("long"))
    new = {"content": F.when(F.col("_has"), F.array_join(kept, "\n")).otherwise(F.col("content")), "qa_issues": F.when(F.col("_has"), append_note(F.col("qa_issues"), F.col("entry"), now)).otherwise(F.col("qa_issues"))}
    return out.withColumns(new).drop("_has", "_lines")


def canonical_blocks(company: Column, amount: Column, round_type: Column, investors: Column, sources: Column) -> Column:
    """A page from the template as an array of (type, text, url)."""
    block = lambda kind, text=None, url=None: F.struct(F.lit(kind).alias("type"), (text if isinstance(text, Column) else F.lit(text).cast("string")).alias("text"), (url if isinstance(url, Column) else F.lit(url).cast("string")).alias("url"))
    shown = F.concat_ws(" ", format_amount(amount), round_type)
    names = F.when(F.size(investors) > 0, F.array_join(investors, ", ")).otherwise("Unknown")
    listed = F.when(F.size(investors) > 0, F.transform(investors, lambda x: block("bulleted_list_item", x))).otherwise(F.array(block("bulleted_list_item", "No investors identified yet.")))
    marks = F.when(F.size(sources) > 0, F.transform(sources, lambda x: block("bookmark", None, x))).otherwise(F.array(block("paragraph", "Sources pending.")))
    part = lambda m, text: [block("divider"), block("paragraph", m[0]), block("paragraph", text), block("paragraph", m[1])]
    return F.concat(
        F.array(
            block("callout", F.concat(F.lit("\U0001f4b0 "), company, F.lit(" — "), shown, F.lit(" | Auto-detected by Funding Intel Pipeline"))), block("divider"), block("heading_2", "DEAL SUMMARY"),
            block("bulleted_list_item", F.concat(F.lit("Company: "), company)), block("bulleted_list_item", F.concat(F.lit("Round: "), shown)), block("bulleted_list_item", F.concat(F.lit("Investors: "), names)), block("heading_2", "INVESTORS"),
        ),
        listed, F.array(block("heading_2", "SOURCES")), marks,
        F.array(*part(OUTREACH, "Outreach enrichment pending — will be populated by founder-intel-pipeline."), *part(HIRING, "Hiring intelligence pending — will be populated by hiring_intel_module.")),
    )


def title(company: Column, amount: Column, round_type: Column, now: Column) -> Column:
    return F.concat(company, F.lit(" — "), format_amount(amount), F.lit(" "), round_type, F.lit(" | FUNDING INTEL | "), F.upper(F.date_format(now, "MMM d, yyyy")))


def page_properties(company: Column, amount: Column, round_type: Column, run_id: Column, now: Column, poc: Column | None = None) -> list[Column]:
    """The columns of a new page; poc, an array of user ids, only if it is given (null where it is empty)."""
    return [
        title(company, amount, round_type, now).alias("entry"), F.lit("FUNDRAISING INTEL").alias("type"), F.lit("funding-intel-brief").alias("source_skill"), report_key(company, amount).alias("report_key"),
        run_id.alias("run_id"), F.lit("PASS").alias("qa_status"), F.lit("").alias("qa_issues"), company.alias("company"), amount.alias("round_amount"),
        *([F.when(F.size(poc) > 0, poc).alias("poc")] if poc is not None else []),
    ]
