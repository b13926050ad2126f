"""Text functions as Column expressions: stripping, error scans, cleaning, sections, markers."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and texts that decide results.
ERROR_PATTERNS = [
    r"HTTPSConnectionPool\(",
    r"Max retries exceeded",
    r"Read timed out",
    r"\[Grok error:",
    r"mcp_unavailable",
    r"ConnectionError\(",
    r"Traceback \(most recent call last\)",
    r"requests\.exceptions\.",
    r"TimeoutError",
    r"Search error: HTTPSConnectionPool",
]
BLANKING_PATTERNS = [
    r".*Search error: HTTPSConnectionPool\(host='html\.duckduckgo\.com'.*",
    r".*\[Grok error: HTTPSConnectionPool\(host='api\.x\.ai'.*?\].*",
    r".*HTTPSConnectionPool\(host=.*?Max retries exceeded.*",
    r".*requests\.exceptions\.\w+Error.*",
    r".*ConnectionError\(MaxRetryError.*",
]
TRACEBACK = r"Traceback \(most recent call last\):.*?(?=\n\S|\z)"
REPLACEMENTS = [
    (r"- Status: mcp_unavailable\n- Notes: Icebreaker MCP URL not configured.*", "- Status: Pending — Icebreaker integration not yet configured."),
    (r"\[Grok error:.*?\]", "[Analysis unavailable — API timeout. Manual review recommended.]"),
    (r"Search error: HTTPSConnectionPool.*?(?=\n|\z)", "[Search unavailable — service timeout.]"),
]
ERROR_ONLY = [
    r"^Search error: HTTPSConnectionPool",
    r"^\[Grok error:.*\]\z",
    r"^mcp_unavailable\z",
    r"^Traceback \(most recent call last\):",
    r"^requests\.exceptions\.",
    r"^HTTPSConnectionPool\(host=.*Max retries exceeded",
]
MAP_NOTE = "> Warm intro mapping pending — Icebreaker MCP integration not yet configured. Manual warm intro research recommended.\n\n"


# The characters that Unicode calls white space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    # trimming by a set of characters walks over the whole text: only texts with white space at an end are worth it
    edges = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1))
    return F.when(edges.rlike(f"[{WHITE_SPACE}]"), F.btrim(c, F.lit(WHITE_SPACE))).otherwise(c)


def occurrences(c: Column, literal: str) -> Column:
    """Non-overlapping occurrences of a literal: by how much the text shrinks without them."""
    return ((F.octet_length(c) - F.octet_length(F.replace(c, F.lit(literal), F.lit("")))) / len(literal.encode())).cast("long")


def bound(value: Column, then) -> Column:
    """then(value), with value computed once for a row however often `then` uses it."""
    return F.transform(F.array(value), then)[0]


def contains_any_case(c: Column, literal: str, up: Column | None = None) -> Column:
    """up: c in upper case, where the caller has it as a column of its own; it is dear for texts that aren't ASCII."""
    return (F.upper(c) if up is None else up).contains(literal.upper())


# what the first three characters of any of the patterns' matches are among: most places of a text fail here already
_BEGIN = "(?=" + "".join("[" + "".join(sorted({re.escape(p.replace("\\", "")[i]) for p in ERROR_PATTERNS})) + "]" for i in range(3)) + ")"


def error_hits(c: Column, up: Column | None = None) -> Column:
    """Distinct error texts, in order of first appearance."""
    hits = F.array_distinct(F.regexp_extract_all(c, F.lit("(?i)" + _BEGIN + "(?:" + "|".join(ERROR_PATTERNS) + ")"), F.lit(0)))
    # the patterns are plain words but for escapes: only texts with one of them are worth the expression
    there = reduce(lambda a, b: a | b, (contains_any_case(c, p.replace("\\", ""), up) for p in ERROR_PATTERNS))
    return F.when(there, hits).otherwise(F.array().cast("array<string>"))


def error_only(c: Column) -> Column:
    s = strip(c)
    hit = F.lit(False)
    for p in ERROR_ONLY:
        hit = hit | s.rlike("(?s)" + p)
    return (s != "") & hit


def _when_has(c: Column, hint: str, change) -> Column:
    return bound(c, lambda x: F.when(x.contains(hint), change(x)).otherwise(x))


def sanitize_text(c: Column, mode: str = "literal") -> Column:
    """Removals, then inline replacements, then blank lines, then strip.

    literal: a removal's `.` crosses lines, so a hit blanks the text. line: only the line with the hit goes.
    """
    # each pattern runs on the texts that have its literal part only
    for p, hint in zip(BLANKING_PATTERNS, ("html.duckduckgo.com", "api.x.ai", "Max retries exceeded", "requests.exceptions.", "ConnectionError(MaxRetryError")):
        if mode == "literal":
            # `.*` on both sides of a hit takes the whole text
            inner = p.removeprefix(".*").removesuffix(".*")
            c = _when_has(c, hint, lambda x, inner=inner: F.when(x.rlike("(?s)" + inner), F.lit("")).otherwise(x))
        else:
            line = "(?d)(?m)^" + p.replace(".*?", "[^\\n]*?") + "$\\n?"
            c = _when_has(c, hint, lambda x, line=line: F.regexp_replace(x, line, ""))
    c = _when_has(c, "Traceback (most recent", lambda x: F.regexp_replace(x, "(?s)" + TRACEBACK, ""))
    for (p, new), hint in zip(REPLACEMENTS, ("- Status: mcp_unavailable", "[Grok error:", "Search error: HTTPSConnectionPool")):
        c = _when_has(c, hint, lambda x, p=p, new=new: F.regexp_replace(x, "(?s)" + p, new))
    return bound(_when_has(c, "\n\n\n", lambda x: F.regexp_replace(x, r"\n{3,}", "\n\n")), strip)


def section_literal(c: Column, heading: str, up: Column | None = None) -> Column:
    """What follows the last newline of a text that has the heading; null where it hasn't.

    The text has it if, after the first `#` that begins a line, the words come anywhere, and a newline after them.
    """
    up = F.upper(c) if up is None else up
    there = F.when(up.contains(heading.upper()), up.rlike(rf"(?s)\A(?:#|.*?\n#).*{re.escape(heading.upper())}.*\n"))
    return F.when(there, strip(F.substring_index(c, "\n", -1)))


def section(c: Column, heading: str) -> Column:
    """The lines below the first heading with this text, up to the next heading; null where there's none."""
    parts = F.split(F.concat(F.lit("\n"), c), r"\n(?=#+\s)", -1)
    mine = F.filter(parts, lambda p: F.upper(F.substring_index(p, "\n", 1)).contains(heading.upper()) & p.startswith("#"))
    return F.when(F.size(mine) > 0, strip(F.regexp_replace(mine[0], r"^[^\n]*\n?", "")))


def bullets(c: Column) -> Column:
    """Lines that begin with a dash or a bullet, white space aside."""
    return F.regexp_count(c, F.lit(f"(?dm)^[{WHITE_SPACE}]*[-•]")).cast("long")


def replace_between(c: Column, start: str, end: str, new: Column | str) -> Column:
    """The text between the first start marker and the first end marker after it replaced; unchanged without both."""
    new = F.lit(new) if isinstance(new, str) else new
    tail = F.substr(c, F.instr(c, start) + len(start))
    there = (F.instr(c, start) > 0) & (F.instr(tail, end) > 0)
    return F.when(there, F.concat(F.substr(c, F.lit(1), F.instr(c, start) - 1 + len(start)), F.lit("\n"), new, F.lit("\n"), F.substr(tail, F.instr(tail, end)))).otherwise(c)


def wrap(c: Column, heading: str, start: str, end: str) -> Column:
    return F.concat_ws("\n", F.lit(start), F.lit(f"## {heading}"), c, F.lit(end))


def append_note(issues: Column, title: Column, ts: Column) -> Column:
    """A dedup note goes to the issues, not to the body."""
    return strip(F.concat(F.coalesce(issues, F.lit("")), F.lit("\nArchived: "), title, F.lit(" ("), ts, F.lit(")")))


def clean_map_sections(c: Column) -> Column:
    """The body of each warm-intro-map section that has `mcp_unavailable` replaced by a note.

    A section runs to a blank line before a heading, or to the end if the text ends in a newline; texts without the token stay.
    """
    body = r"((?:.*\n)*?)(?=\n##\s|\z)"
    found = rf"(?dm)(##\s*.*INVESTOR.*WARM INTRO MAP.*\n){body}"
    # a section is rewritten if its body has the token: sections are cut out one by one, since a replacement can't look inside
    parts = F.regexp_extract_all(c, F.lit(found), F.lit(0))
    heads = F.regexp_extract_all(c, F.lit(found), F.lit(1))
    gaps = F.split(c, found, -1)
    rows = F.arrays_zip(gaps.alias("gap"), parts.alias("part"), heads.alias("head"))
    new = F.transform(rows, lambda r: F.concat(F.coalesce(r["gap"], F.lit("")), F.when(F.coalesce(r["part"], F.lit("")).contains("mcp_unavailable"), F.concat(r["head"], F.lit(MAP_NOTE))).otherwise(F.coalesce(r["part"], F.lit("")))))
    return F.when(c.contains("mcp_unavailable"), F.array_join(new, "")).otherwise(c)


DEDUP_NOTES = ("Archived duplicate:", "Dedup cleanup")
"""Fixed values: notes on duplicates that belong in a page's issues, not in its body."""


def has_dedup_note(c: Column) -> Column:
    return F.contains(c, F.lit(DEDUP_NOTES[0])) | F.contains(c, F.lit(DEDUP_NOTES[1]))
