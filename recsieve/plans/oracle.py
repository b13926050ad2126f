"""The same queries in DuckDB's SQL, written on the raw tables."""

from __future__ import annotations

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
SLUG = r"trim(regexp_replace(regexp_replace(regexp_replace(trim(lower({0}), e' \t\n'), '[^a-z0-9\s-]', '', 'g'), '\s+', '-', 'g'), '-+', '-', 'g'), '-')"

DEALS = r"""
raw AS (SELECT o_orderkey AS id, replace(c_name, '#', ' ') AS company, o_orderpriority AS round_type, o_orderdate AS seen_at,
    floor(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1::DOUBLE WHEN 1 THEN 100::DOUBLE WHEN 2 THEN 10000::DOUBLE ELSE 0.001::DOUBLE END)::BIGINT AS n,
    CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'run-' || o_orderkey END AS run_id
  FROM orders JOIN customer ON o_custkey = c_custkey),
texted AS (SELECT *, CASE WHEN id % 97 = 0 THEN NULL ELSE CASE id % 8 WHEN 0 THEN '$' || (n // 1000000) || 'M'
    WHEN 1 THEN '$' || (n // 1000000) || '.' || lpad((n % 1000000 // 10000)::VARCHAR, 2, '0') || 'M' WHEN 2 THEN (n // 1000) || 'K'
    WHEN 3 THEN '$' || (n // 1000) || ',' || lpad((n % 1000)::VARCHAR, 3, '0') WHEN 4 THEN '' WHEN 5 THEN 'undisclosed'
    WHEN 6 THEN ' -$ ' || (n // 1000) || 'k ' ELSE (n // 1000000) || '.5b' END END AS amount_str FROM raw),
bare AS (SELECT *, trim(replace(replace(coalesce(amount_str, ''), '$', ''), ',', '')) AS s FROM texted),
split AS (SELECT *, CASE upper(right(s, 1)) WHEN 'B' THEN 1e9 WHEN 'M' THEN 1e6 WHEN 'K' THEN 1e3 ELSE 1.0 END::DOUBLE AS times,
    trim(CASE WHEN upper(right(s, 1)) IN ('B', 'M', 'K') THEN left(s, -1) ELSE s END) AS body FROM bare),
valued AS (SELECT *, coalesce(trunc(CASE WHEN regexp_matches(body, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') THEN try_cast(body AS DOUBLE) * times END)::BIGINT, 0) AS amount, """ + SLUG.format("company") + r""" AS slug FROM split),
deals AS (SELECT id, company, slug, amount_str, amount, 'fundraising-intel:v3:' || slug || ':' || amount AS report_key, round_type, run_id, seen_at FROM valued)
"""

PAGES = DEALS + r""",
pages_ AS (SELECT id AS page_id, CASE WHEN id % 23 = 0 THEN '[Archived] ' ELSE '' END || company AS entry,
    CASE id // 7 % 3 WHEN 0 THEN 'FUNDRAISING INTEL' WHEN 1 THEN 'SIGNAL PACK' ELSE 'OUTREACH TARGET' END AS type, CASE WHEN id % 19 = 0 THEN '' ELSE 'funding-intel-brief' END AS source_skill,
    CASE WHEN id % 17 = 0 THEN '' WHEN id % 3 = 0 THEN 'fundraising-intel:' || slug || ':' || strftime(seen_at, '%Y-%m-%d') ELSE report_key END AS report_key, run_id, company, slug, seen_at AS date,
    concat(CASE WHEN id % 7 = 0 THEN '' ELSE text END,
      CASE id % 5 WHEN 1 THEN e'\n[[OUTREACH_INTEL_AUTO_START]]' WHEN 2 THEN e'\n[[OUTREACH_INTEL_AUTO_END]]' WHEN 3 THEN e'\n[[OUTREACH_INTEL_AUTO_START]]x[[OUTREACH_INTEL_AUTO_END]]'
          WHEN 4 THEN e'\n[[OUTREACH_INTEL_AUTO_START]]x[[OUTREACH_INTEL_AUTO_START]]y[[OUTREACH_INTEL_AUTO_END]]' ELSE '' END,
      CASE id % 6 WHEN 1 THEN '' WHEN 2 THEN e'\n[[HIRING_INTEL_AUTO_START]]' WHEN 3 THEN e'\n[[HIRING_INTEL_AUTO_END]]' WHEN 5 THEN e'\n[[HIRING_INTEL_AUTO_START]][[HIRING_INTEL_AUTO_START]][[HIRING_INTEL_AUTO_END]]'
          ELSE e'\n[[HIRING_INTEL_AUTO_START]]x[[HIRING_INTEL_AUTO_END]]' END,
      CASE id % 11 WHEN 0 THEN e'\n- mcp_unavailable mcp_unavailable' WHEN 1 THEN e'\nTIMEOUTERROR timeouterror' WHEN 2 THEN e'\n[Grok error: quota] tail'
          WHEN 3 THEN e'\nSearch error: HTTPSConnectionPool(host=''other'') x\n\n\n\nmore' WHEN 4 THEN e'\nHTTPSConnectionPool(host=a): Max retries exceeded' ELSE '' END,
      CASE id % 13 WHEN 0 THEN e'\nMarket Snapshot and signal' WHEN 1 THEN e'\nDeal Summary\nSources' ELSE '' END,
      CASE id % 4 WHEN 0 THEN e'\n# INVESTORS\n- a\n- b' WHEN 1 THEN e'\n# INVESTORS\n- a\n' WHEN 2 THEN e'\n## Investors\nnone' ELSE '' END) AS content
  FROM deals LEFT JOIN documents ON doc_id = id % (SELECT count(*) FROM documents)),
keyed AS (SELECT *, string_split(report_key, ':') AS p FROM pages_),
pages_k AS (SELECT *, CASE WHEN p[1] = 'fundraising-intel' AND len(p) = 4 AND p[2] = 'v3' THEN 'v3' WHEN p[1] = 'fundraising-intel' AND len(p) = 3 THEN 'legacy' ELSE 'none' END AS scheme FROM keyed)
"""

MATCH = "CASE WHEN {0} = 0 OR {1} = 0 THEN {0} = {1} ELSE abs({0} - {1})::DOUBLE / greatest({0}, {1}) <= 0.05 END"

BLOCKS = r"""
blocks AS (SELECT conv_id AS page_id, turn AS pos, CASE (conv_id + turn) % 9 WHEN 0 THEN 'mcp_unavailable' WHEN 1 THEN text || ' [Grok error: q] b' WHEN 2 THEN '[Grok error: x] ' || text || ' [y]'
    WHEN 3 THEN 'Search error: HTTPSConnectionPool(host=''o'') ' || text WHEN 4 THEN e'a\nHTTPSConnectionPool(host=a): Max retries exceeded\n' || text WHEN 5 THEN e' \n' || text || e'\n\n\n\nz' WHEN 6 THEN NULL ELSE text END AS text FROM conversations)
"""


def clean(c: str) -> str:
    """Literal cleaning; RE2 has no lookahead, so an error that runs to the end of its line is matched by `[^\\n]*`. The inputs have no traceback."""
    for i, p in enumerate((r"Search error: HTTPSConnectionPool\(host=''html\.duckduckgo\.com''", r"\[Grok error: HTTPSConnectionPool\(host=''api\.x\.ai''.*?\]", r"HTTPSConnectionPool\(host=.*?Max retries exceeded", r"requests\.exceptions\.\w+Error", r"ConnectionError\(MaxRetryError")):
        c = f"CASE WHEN regexp_matches({c}, '{p}', 's') THEN '' ELSE {c} END" if c.isidentifier() else f"(SELECT CASE WHEN regexp_matches(q{i}, '{p}', 's') THEN '' ELSE q{i} END FROM (SELECT {c} AS q{i}))"
    return inline(c)


def clean_lines(c: str) -> str:
    """Only lines with a hit go."""
    bad = r"Search error: HTTPSConnectionPool\(host=''html\.duckduckgo\.com''|\[Grok error: HTTPSConnectionPool\(host=''api\.x\.ai''.*\]|HTTPSConnectionPool\(host=.*Max retries exceeded|requests\.exceptions\.\w+Error|ConnectionError\(MaxRetryError"
    return inline(rf"array_to_string(list_filter(string_split({c}, e'\n'), lambda l: NOT regexp_matches(l, '{bad}')), e'\n')")


def inline(c: str) -> str:
    for p, new in ((r"- Status: mcp_unavailable\n- Notes: Icebreaker MCP URL not configured.*", "- Status: Pending — Icebreaker integration not yet configured."), (r"\[Grok error:.*?\]", "[Analysis unavailable — API timeout. Manual review recommended.]"), (r"Search error: HTTPSConnectionPool[^\n]*", "[Search unavailable — service timeout.]")):
        c = f"regexp_replace({c}, '{p}', '{new}', 'gs')"
    return STRIP.format(rf"regexp_replace({c}, '\n{{3,}}', e'\n\n', 'g')")


ERRORS = r"(?i)HTTPSConnectionPool\(|Max retries exceeded|Read timed out|\[Grok error:|mcp_unavailable|ConnectionError\(|Traceback \(most recent call last\)|requests\.exceptions\.|TimeoutError|Search error: HTTPSConnectionPool"
HITS = f"list_filter(regexp_extract_all(content, '{ERRORS}'), lambda x, i: list_position(regexp_extract_all(content, '{ERRORS}'), x) = i)"


def count(literal: str, c: str = "content") -> str:
    return f"((length({c}) - length(replace({c}, '{literal}', ''))) // {len(literal)})::BIGINT"


OS, OE, HS, HE = "[[OUTREACH_INTEL_AUTO_START]]", "[[OUTREACH_INTEL_AUTO_END]]", "[[HIRING_INTEL_AUTO_START]]", "[[HIRING_INTEL_AUTO_END]]"
LAST = STRIP.format(r"regexp_extract(content, '[^\n]*$')")
SECTION = rf"CASE WHEN regexp_matches(content, '(?is)(?:^|\n)#+\s*.*INVESTORS.*\n') THEN {LAST} END"

RULES = [
    ("FAIL", "report_key = ''", "'Empty REPORT KEY — page is invisible to dedup system.'"),
    ("FAIL", f"len({HITS}) > 0", f"'Error text in body: ' || array_to_string(({HITS})[1:3], ', ')"),
    ("FAIL", "intel AND (os > 0) <> (oe > 0)", "'Unpaired outreach markers — START without END or vice versa.'"),
    ("FAIL", "intel AND (hs > 0) <> (he > 0)", "'Unpaired hiring markers — START without END or vice versa.'"),
    ("WARN", "intel AND os = 0", "'Missing outreach enrichment section (no markers found).'"),
    ("WARN", "intel AND hs = 0", "'Missing hiring intelligence section (no markers found).'"),
    ("FAIL", "intel AND os > 1", "'Stacked outreach sections: ' || os || ' START markers found.'"),
    ("FAIL", "intel AND hs > 1", "'Stacked hiring sections: ' || hs || ' START markers found.'"),
    ("WARN", "intel AND section <> '' AND left(section, 1) NOT IN ('-', '•')", "'No investors listed.'"),
    ("WARN", "intel AND left(section, 1) IN ('-', '•')", "'Only 1 investor(s) listed — verify completeness.'"),
    ("WARN", "intel AND noise > 0", "'Icebreaker MCP unavailable (' || noise || ' entries) — warm intro map is placeholder only.'"),
    ("WARN", "intel AND size < 500", "'Page content is very thin (<500 chars) — likely a bare skeleton.'"),
    ("WARN", "pack AND NOT contains(upper(content), 'MARKET SNAPSHOT')", "'Missing expected section: MARKET SNAPSHOT'"),
    ("WARN", "pack AND NOT contains(upper(content), 'SIGNAL')", "'Missing expected section: SIGNAL'"),
    ("WARN", "pack AND size < 300", "'Signal Pack content is very thin (<300 chars).'"),
    ("WARN", "source_skill = ''", "'Empty SOURCE SKILL — pipeline traceability lost.'"),
    ("WARN", "run_id = ''", "'Empty RUN ID — cannot trace to specific pipeline run.'"),
]
HEADING = r"regexp_matches(l || e'\n', '^#+\s')"
FROM_HEADING = f"list_transform(string_split(content, e'\\n'), lambda l: {HEADING} AND contains(upper(l), 'INVESTORS'))"
AFTER = f"string_split(content, e'\\n')[list_position({FROM_HEADING}, true) + 1:]"
NEXT = f"nullif(list_position(list_transform({AFTER}, lambda l: {HEADING}), true), 0)"
INTENDED = f"CASE WHEN list_contains({FROM_HEADING}, true) THEN " + STRIP.format(f"array_to_string(({AFTER})[:coalesce({NEXT} - 1, len({AFTER}))], e'\\n')") + " END"
N = r"len(list_filter(string_split(section, e'\n'), lambda l: regexp_matches(l, '^\s*[-•]')))"
INTENDED_RULES = [
    *RULES[:8],
    ("WARN", f"intel AND section <> '' AND {N} = 0", "'No investors listed.'"),
    ("WARN", f"intel AND {N} BETWEEN 1 AND 2", f"'Only ' || {N} || ' investor(s) listed — verify completeness.'"),
    *RULES[10:],
]


def judged(rules: list[tuple[str, str, str]], section: str) -> str:
    return PAGES + f""",
facts AS (SELECT *, type = 'FUNDRAISING INTEL' AS intel, type = 'SIGNAL PACK' AS pack, {count(OS)} AS os, {count(OE)} AS oe, {count(HS)} AS hs, {count(HE)} AS he,
    {section} AS section, {count("mcp_unavailable")} AS noise, length({STRIP.format("content")}) AS size, contains(upper(entry), '[ARCHIVED') AS gone FROM pages_),
judged AS (SELECT page_id, gone, list_filter([{", ".join(f"CASE WHEN {c} THEN {m} END" for _, c, m in rules)}], lambda x: x IS NOT NULL) AS msgs, {" OR ".join(f"coalesce({c}, false)" for s, c, _ in rules if s == "FAIL")} AS failed FROM facts),
qa AS (SELECT page_id, CASE WHEN gone THEN 'SKIP' WHEN failed THEN 'FAIL' WHEN len(msgs) > 0 THEN 'WARN' ELSE 'PASS' END AS qa_status,
    CASE WHEN gone THEN '' WHEN len(msgs) = 0 THEN 'All checks passed.' ELSE left(array_to_string(msgs, ' | '), 2000) END AS qa_issues FROM judged)
"""


QA = judged(RULES, SECTION)

FORMAT = """CASE WHEN {0} >= 1000000000 THEN '$' || printf('%.1f', {0} / 1e9::DOUBLE) || 'B' WHEN {0} >= 1000000 AND {0} % 1000000 = 0 THEN '$' || ({0} // 1000000) || 'M'
    WHEN {0} >= 1000000 THEN '$' || printf('%.1f', {0} / 1e6::DOUBLE) || 'M' WHEN {0} >= 1000 THEN '$' || printf('%.0f', {0} / 1e3::DOUBLE) || 'K' WHEN {0} > 0 THEN '$' || {0} ELSE '$0' END"""

INVESTORS = r"""
lines AS (SELECT l_orderkey AS id, l_linenumber, l_suppkey, CASE (l_linenumber + l_orderkey) % 9 WHEN 0 THEN '(co-founder' WHEN 1 THEN s_name || ')' WHEN 2 THEN 'Jane Roe (CEO/co-founder' WHEN 3 THEN ' ' || upper(s_name) || ' '
    WHEN 4 THEN 'Partner' WHEN 5 THEN '' WHEN 6 THEN s_name || ' (NY)' ELSE s_name END AS name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
placed AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY l_linenumber, l_suppkey, name) AS k FROM lines),
lists AS (SELECT id, count(*) AS n_raw FROM lines GROUP BY id)
"""
ROLES = "['co-founder', 'cofounder', 'ceo', 'cto', 'cfo', 'coo', 'founder', 'partner', 'managing director', 'president', 'vp ', 'vice president', 'head of', 'director of']"
SPEC = "['co-founder', 'ceo', 'cto', 'cfo', 'founder', 'partner']"
CLEANED = INVESTORS + rf""",
kept AS (SELECT id, k, trim(name) AS x, lower(trim(name)) AS y FROM placed),
good AS (SELECT *, row_number() OVER (PARTITION BY id, y ORDER BY k) AS r FROM kept WHERE x <> '' AND NOT starts_with(x, '(') AND NOT (ends_with(x, ')') AND NOT contains(x, '('))
    AND NOT (contains(x, '(') AND len(list_filter({ROLES}, lambda q: contains(y, q))) > 0) AND len(list_filter({ROLES}, lambda q: y = q OR starts_with(y, q || ' '))) = 0),
cleaned AS (SELECT id, coalesce(string_agg(x, '|' ORDER BY k) FILTER (WHERE r = 1), '') AS names, count(*) FILTER (WHERE r = 1) AS n_clean FROM lists LEFT JOIN good USING (id) GROUP BY id)
"""

CALLS = "calls AS (SELECT user_id % 4 AS service, epoch_us(ts) / 1000000::DOUBLE AS t, event_id AS id, event_type <> 'error' AS ok FROM events)"


def _blocks() -> str:
    b = lambda kind, text="NULL", url="NULL": f"{{'type': '{kind}', 'text': ({text})::VARCHAR, 'url': ({url})::VARCHAR}}"
    q = lambda s: f"'{s}'"
    shown = f"({FORMAT.format('amount')}) || ' ' || round_type"
    head = [b("callout", f"'💰 ' || company || ' — ' || {shown} || ' | Auto-detected by Funding Intel Pipeline'"), b("divider"), b("heading_2", q("DEAL SUMMARY")), b("bulleted_list_item", "'Company: ' || company"), b("bulleted_list_item", f"'Round: ' || {shown}"), b("bulleted_list_item", "'Investors: ' || CASE id % 3 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Fund ' || id ELSE 'A, B' || id END"), b("heading_2", q("INVESTORS"))]
    names = f"CASE id % 3 WHEN 0 THEN [{b('bulleted_list_item', q('No investors identified yet.'))}] WHEN 1 THEN [{b('bulleted_list_item', chr(39) + 'Fund ' + chr(39) + ' || id')}] ELSE [{b('bulleted_list_item', q('A'))}, {b('bulleted_list_item', chr(39) + 'B' + chr(39) + ' || id')}] END"
    links = f"CASE id % 2 WHEN 0 THEN [{b('paragraph', q('Sources pending.'))}] ELSE [{b('bookmark', 'NULL', chr(39) + 'http://s/' + chr(39) + ' || id')}, {b('bookmark', 'NULL', q('http://t'))}] END"
    tail = [b("divider"), b("paragraph", q(OS)), b("paragraph", q("Outreach enrichment pending — will be populated by founder-intel-pipeline.")), b("paragraph", q(OE)), b("divider"), b("paragraph", q(HS)), b("paragraph", q("Hiring intelligence pending — will be populated by hiring_intel_module.")), b("paragraph", q(HE))]
    whole = f"[{', '.join(head)}] || {names} || [{b('heading_2', q('SOURCES'))}] || {links} || [{', '.join(tail)}]"
    return f"WITH {DEALS}, built AS (SELECT id, {whole} AS bs FROM deals) SELECT id, pos - 1 AS pos, bs[pos].type AS type, bs[pos].text AS text, bs[pos].url AS url FROM (SELECT id, bs, unnest(range(1, len(bs) + 1)) AS pos FROM built)"


D, P = f"WITH {DEALS}", f"WITH {PAGES}"
_pos = "strpos(content, '{0}')"
_tail = f"substr(content, strpos(content, '{HS}') + {len(HS)})"
SQL: dict[str, str] = {
    "dup_key_clusters": f"{D} SELECT report_key, count(*) AS n, min(id) AS first_id FROM deals GROUP BY report_key HAVING count(*) > 1",
    "slug_key": f"{D} SELECT id, slug, report_key FROM deals",
    "part_slugs": r"SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(p_name || '_x -- É' || p_brand || '-'), '[^a-z0-9\s-]', '', 'g'), '\s+', '-', 'g'), '-+', '-', 'g'), '-') AS slug FROM part",
    "legacy_outreach_pack_keys": f"{D} SELECT id, 'fundraising-intel:' || slug || ':' || strftime(seen_at, '%Y-%m-%d') AS legacy, 'fundraising-intel:' || slug || ':' AS prefix, 'outreach-intel:' || slug || ':' || amount AS outreach, 'signal-pack:v1:' || strftime(seen_at, '%Y-%m-%d') AS pack FROM deals",
    "parsed_keys": f"{P} SELECT page_id, scheme, CASE scheme WHEN 'v3' THEN p[3] WHEN 'legacy' THEN p[2] END AS slug, CASE WHEN scheme <> 'none' THEN p[-1] END AS suffix FROM pages_k",
    "parse_amount": f"{D} SELECT id, amount_str, amount FROM deals",
    "format_amount": f"WITH n AS (SELECT o_orderkey AS id, floor(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1::DOUBLE WHEN 1 THEN 100::DOUBLE WHEN 2 THEN 10000::DOUBLE ELSE 0.001::DOUBLE END)::BIGINT AS n, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 4 = 2 THEN 50000000 WHEN o_orderkey % 4 = 1 THEN 50000 ELSE 500 END AS step FROM orders), a AS (SELECT id, (n - n % step)::BIGINT AS amount FROM n) SELECT id, amount, {FORMAT.format('amount')} AS shown FROM a",
    "page_properties": f"{D} SELECT id, company || ' — ' || ({FORMAT.format('amount')}) || ' ' || round_type || ' | FUNDING INTEL | MAR 8, 2026' AS entry, 'FUNDRAISING INTEL' AS type, 'funding-intel-brief' AS source_skill, report_key, run_id, 'PASS' AS qa_status, '' AS qa_issues, company, amount AS round_amount FROM deals",
    "amount_match_pairs": f"{D} SELECT x.id AS a, y.id AS b FROM deals x JOIN deals y ON x.slug = y.slug AND x.id < y.id WHERE {MATCH.format('x.amount', 'y.amount')}",
    "amount_band_pairs": f"WITH l AS (SELECT s_suppkey AS a, floor(abs(s_acctbal))::BIGINT AS m FROM supplier), r AS (SELECT p_partkey AS b, floor(p_retailprice)::BIGINT AS n FROM part) SELECT a, b FROM l, r WHERE {MATCH.format('m', 'n')}",
    "amount_conflicts": f"{D}, g AS (SELECT slug, year(seen_at) AS year, min(amount) AS low, max(amount) AS high, count(DISTINCT amount) AS n_amounts FROM deals WHERE amount > 0 GROUP BY ALL) SELECT * FROM g WHERE NOT {MATCH.format('low', 'high')}",
    "canonical_pick": f"{P} SELECT slug, page_id, report_key FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY CASE WHEN scheme = 'v3' THEN 0 ELSE 1 END, CASE WHEN coalesce(CASE WHEN scheme <> 'none' THEN p[-1] END, '0') <> '0' THEN 0 ELSE 1 END, date, page_id) AS k FROM pages_k) WHERE k = 1",
    "legacy_or_v3_lookup": f"{P} SELECT id, page_id, scheme FROM deals d JOIN pages_k k USING (report_key) WHERE scheme = 'v3' UNION ALL SELECT id, page_id, scheme FROM deals d JOIN pages_k k ON k.scheme = 'legacy' AND k.p[2] = d.slug",
    "zero_amount_guard": f"{P}, k AS (SELECT company, min(page_id) AS page_id FROM pages_ WHERE type = 'FUNDRAISING INTEL' GROUP BY company) SELECT id, CASE WHEN amount <> 0 THEN 'key' WHEN page_id IS NOT NULL THEN 'reuse' ELSE 'flag' END AS action, CASE WHEN amount = 0 THEN page_id END AS page_id FROM deals LEFT JOIN k USING (company)",
    "canonical_missing": f"{P} SELECT id, slug FROM deals WHERE slug NOT IN (SELECT slug FROM pages_ WHERE type = 'FUNDRAISING INTEL')",
    "canonical_present": f"{P} SELECT id, slug FROM deals WHERE slug IN (SELECT slug FROM pages_ WHERE type = 'FUNDRAISING INTEL')",
    "outreach_pairs": f"{P}, c AS (SELECT slug, min(page_id) AS canonical_id, count(*) AS n_canonical FROM pages_ WHERE type = 'FUNDRAISING INTEL' GROUP BY slug) SELECT page_id, canonical_id, n_canonical FROM pages_ JOIN c USING (slug) WHERE type = 'OUTREACH TARGET'",
    "company_contains": "SELECT c_custkey AS id, lower(n_name) AS needle FROM customer JOIN nation ON contains(upper('Nation_' || c_nationkey || ' ' || c_name), upper(n_name))",
    "greedy_dedup": f"""WITH RECURSIVE {DEALS}, o AS (SELECT id, slug, amount, row_number() OVER (PARTITION BY slug ORDER BY seen_at, id, amount) AS k FROM deals),
        walk AS (SELECT slug, 1 AS k, [{{'id': id, 'amount': amount}}] AS canon, id, id AS canonical_id FROM o WHERE k = 1
          UNION ALL SELECT w.slug, w.k + 1, CASE WHEN len(list_filter(w.canon, lambda c: {MATCH.format('c.amount', 'o.amount')})) > 0 THEN w.canon ELSE list_append(w.canon, {{'id': o.id, 'amount': o.amount}}) END,
            o.id, coalesce(list_filter(w.canon, lambda c: {MATCH.format('c.amount', 'o.amount')})[1].id, o.id) FROM walk w JOIN o ON o.slug = w.slug AND o.k = w.k + 1) SELECT id, canonical_id FROM walk""",
    "key_schemes": f"{P}, k AS (SELECT slug, CASE WHEN p[1] = 'signal-pack' AND len(p) = 3 THEN 'pack' WHEN p[1] = 'outreach-intel' AND len(p) = 3 THEN 'outreach' ELSE scheme END AS scheme FROM pages_k) SELECT scheme, count(*) AS n FROM k GROUP BY scheme UNION ALL SELECT 'several', count(*) FROM (SELECT slug FROM k WHERE scheme <> 'none' GROUP BY slug HAVING count(DISTINCT scheme) > 1)",
    "dedup_notes": f"{P}, n AS (SELECT page_id, entry, content || CASE page_id % 9 WHEN 1 THEN e'\\nArchived duplicate: x' WHEN 2 THEN e'\\n- Dedup cleanup' WHEN 3 THEN e'\\narchived duplicate: y' ELSE '' END AS c FROM pages_) SELECT page_id, entry FROM n WHERE contains(c, 'Archived duplicate:') OR contains(c, 'Dedup cleanup')",
    "error_hits": f"{P} SELECT page_id, len({HITS}) AS n_hits, array_to_string(({HITS})[1:3], '|') AS first_hits FROM pages_",
    "error_only": rf"WITH {BLOCKS}, s AS (SELECT page_id, pos, {STRIP.format('text')} AS x FROM blocks) SELECT page_id, pos, coalesce(x <> '' AND regexp_matches(x, '^Search error: HTTPSConnectionPool|^\[Grok error:.*\]\z|^mcp_unavailable\z|^Traceback \(most recent call last\):|^requests\.exceptions\.|^HTTPSConnectionPool\(host=.*Max retries exceeded', 's'), false) AS error_only FROM s",
    "marker_counts": f"{P} SELECT page_id, {count(OS)} AS outreach_start, {count(OE)} AS outreach_end, {count(HS)} AS hiring_start, {count(HE)} AS hiring_end FROM pages_",
    "structure_issues": f"{P} SELECT page_id, array_to_string(list_filter([" + ", ".join(
        [f"CASE WHEN NOT contains(upper(content), '{h}') THEN 'Missing required section: {h}' END" for h in ("DEAL SUMMARY", "INVESTORS", "SOURCES")]
        + [f"CASE WHEN NOT contains(content, '{s}') THEN 'Missing start marker for {h}: {s}' END, CASE WHEN NOT contains(content, '{e}') THEN 'Missing end marker for {h}: {e}' END, CASE WHEN {count(s)} > 1 THEN 'Duplicate markers for {h}: ' || {count(s)} || ' instances of {s}' END" for h, s, e in (("OUTREACH INTEL (AUTO)", OS, OE), ("HIRING INTELLIGENCE", HS, HE))]
    ) + "], lambda x: x IS NOT NULL), '|') AS issues FROM pages_",
    "qa_issues": f"WITH {QA} SELECT * FROM qa",
    "qa_issues_intended": f"WITH {judged(INTENDED_RULES, INTENDED)} SELECT * FROM qa",
    "qa_status_histogram": f"WITH {QA} SELECT s AS qa_status, count(page_id) AS n_pages FROM (SELECT unnest(['PASS', 'WARN', 'FAIL', 'SKIP']) AS s) LEFT JOIN qa ON s = qa_status GROUP BY s",
    "archived_skip": f"{P} SELECT page_id, entry FROM pages_ WHERE contains(upper(entry), '[ARCHIVED')",
    "recent_pages": f"{P} SELECT page_id, date FROM pages_ WHERE date > TIMESTAMP '1998-10-03' - INTERVAL 720 HOUR",
    "investor_section_literal": f"{P} SELECT page_id, {SECTION} AS section FROM pages_",
    "investor_section_intended": f"{P} SELECT page_id, {INTENDED} AS section FROM pages_",
    "pattern_gap": f"""WITH {BLOCKS}, l AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS phrase FROM blocks WHERE text IS NOT NULL)
        SELECT fails, cleaned, count(*) AS n_lines, min(phrase) AS first_line FROM (SELECT phrase, regexp_matches(phrase, '{ERRORS}') AS fails, {clean('phrase')} <> phrase AS cleaned FROM l) GROUP BY ALL""",
    "sanitize_text": f"{P} SELECT page_id, md5({clean('content')}) AS cleaned_md5 FROM pages_",
    "page_text": rf"WITH {BLOCKS} SELECT page_id, md5(string_agg(coalesce(text, ''), e'\n' ORDER BY pos, coalesce(text, ''))) AS content_md5 FROM blocks GROUP BY page_id",
    "cleaner_text": rf"WITH {BLOCKS} SELECT page_id, md5(string_agg(coalesce(text, ''), e'\n' ORDER BY pos, coalesce(text, '')) || e'\n') AS content_md5 FROM blocks GROUP BY page_id",
    "investor_clean": f"WITH {CLEANED} SELECT id, names FROM cleaned",
    "investor_clean_spec": f"""WITH {INVESTORS}, kept AS (SELECT id, k, trim(name) AS x, lower(trim(name)) AS y FROM placed),
        good AS (SELECT *, row_number() OVER (PARTITION BY id, x ORDER BY k) AS r FROM kept WHERE NOT starts_with(y, '(') AND NOT ends_with(y, ')') AND len(list_filter({SPEC}, lambda q: contains(y, '(' || q) OR contains(y, q || ')'))) = 0
          AND NOT (contains(x, '(') AND len(list_filter({SPEC}, lambda q: contains(y, q))) > 0)) SELECT id, coalesce(string_agg(x, '|' ORDER BY k) FILTER (WHERE r = 1), '') AS names FROM lists LEFT JOIN good USING (id) GROUP BY id""",
    "corrupt_investor_lists": f"WITH {CLEANED} SELECT id, n_raw, n_clean FROM lists JOIN cleaned USING (id) WHERE n_raw <> n_clean",
    "canonical_blocks": _blocks(),
    "replace_markers": rf"{P} SELECT page_id, md5(CASE WHEN contains(content, '{HS}') AND contains({_tail}, '{HE}') THEN left(content, strpos(content, '{HS}') - 1 + {len(HS)}) || e'\n' || 'new $1 \ ' || company || e'\n' || substr({_tail}, strpos({_tail}, '{HE}')) ELSE content END) AS content_md5 FROM pages_",
    "wrap_markers": rf"{D} SELECT id, '{HS}' || e'\n## HIRING INTELLIGENCE\n' || company || e'\n' || '{HE}' AS wrapped FROM deals",
    "qa_note_append": rf"{D} SELECT id, trim(CASE WHEN id % 2 = 0 THEN '' ELSE run_id END || e'\nArchived: ' || company || ' (' || strftime(seen_at, '%Y-%m-%d') || ')', e' \n') AS issues FROM deals",
    "failure_runs": f"WITH {CALLS}, i AS (SELECT *, sum(ok::INT) OVER (PARTITION BY service ORDER BY t, id) AS island FROM calls) SELECT service, min(id) AS first_id, count(*) AS run_length FROM i WHERE NOT ok GROUP BY service, island",
    "breaker_states": f"""WITH RECURSIVE {CALLS}, o AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY t, id) AS k FROM calls),
        walk AS (SELECT service, 0::BIGINT AS k, 0::BIGINT AS fails, 0::DOUBLE AS last, false AS is_open, 0::BIGINT AS n_allowed, 0::BIGINT AS n_denied FROM (SELECT DISTINCT service FROM o)
          UNION ALL SELECT service, k, CASE WHEN NOT go THEN fails WHEN ok THEN 0 ELSE fails + 1 END, CASE WHEN go AND NOT ok THEN t ELSE last END, CASE WHEN NOT go THEN true WHEN ok THEN false ELSE fails + 1 >= 2 END, n_allowed + go::INT, n_denied + (NOT go)::INT
            FROM (SELECT w.service, o.k, w.fails, w.last, o.t, o.ok, n_allowed, n_denied, (NOT w.is_open OR o.t - w.last >= 1800) AS go FROM walk w JOIN o ON o.service = w.service AND o.k = w.k + 1))
        SELECT service, n_allowed, n_denied, fails, CASE WHEN is_open THEN 'open' ELSE 'closed' END AS state FROM walk QUALIFY row_number() OVER (PARTITION BY service ORDER BY k DESC) = 1""",
    "backoff_schedule": "SELECT event_id, attempt, (2.0 + event_id % 3)::DOUBLE * pow(2.0, attempt) AS wait FROM (SELECT event_id, unnest(range(0, event_id % 4)) AS attempt FROM events)",
    "retry_class": "WITH n AS (SELECT event_id, ['ConnectionError', 'TimeoutError', 'Timeout', 'ReadTimeout', 'ConnectTimeout', 'MaxRetryError', 'HTTPError', 'ValueError', 'KeyError'][event_id % 9 + 1] AS error FROM events) SELECT event_id, error, CASE WHEN error IN ('HTTPError', 'ValueError', 'KeyError') THEN 'fallback' ELSE 'retry' END AS action FROM n",
    "fallback_text": "SELECT event_id, CASE WHEN event_type <> 'error' THEN props ELSE 'Unavailable.' END AS answer, (event_type <> 'error')::BIGINT AS n_results FROM events",
    "llm_json_path": "SELECT conv_id, turn, md5(json_extract_string(to_json({'choices': [{'message': {'content': text, 'role': role}}]}), '$.choices[0].message.content')) AS content_md5 FROM conversations",
    "event_rollup": "SELECT user_id % 4 AS service, date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) FILTER (WHERE event_type = 'error') AS n_failed, count(*) AS n_calls FROM events GROUP BY ALL",
}
_cleaned = clean("x")
SQL["block_actions"] = rf"""WITH {BLOCKS}, s AS (SELECT page_id, pos, text AS x, {STRIP.format('text')} AS y FROM blocks),
    c AS (SELECT *, {_cleaned} AS z FROM s),
    a AS (SELECT *, CASE WHEN x IS NULL THEN 'keep' WHEN y <> '' AND regexp_matches(y, '^Search error: HTTPSConnectionPool|^\[Grok error:.*\]\z|^mcp_unavailable\z|^Traceback \(most recent call last\):|^requests\.exceptions\.|^HTTPSConnectionPool\(host=.*Max retries exceeded', 's') THEN 'remove'
      WHEN z = x THEN 'keep' WHEN z = '' THEN 'remove' ELSE 'clean' END AS action FROM c)
    SELECT page_id, pos, action, md5(CASE action WHEN 'keep' THEN x WHEN 'clean' THEN z END) AS cleaned_md5 FROM a"""
SQL["block_action_counts"] = SQL["block_actions"].rpartition("SELECT page_id, pos, action")[0] + "SELECT page_id, count(*) FILTER (WHERE action = 'clean') AS n_cleaned, count(*) FILTER (WHERE action = 'remove') AS n_removed FROM a GROUP BY page_id"

SQL["applied_blocks"] = rf"""WITH {BLOCKS.replace("AS pos,", "AS pos, role AS type,")}, s AS (SELECT page_id, pos, type, text AS x, {STRIP.format('text')} AS y FROM blocks),
    c AS (SELECT *, {_cleaned} AS z FROM s),""" + SQL["block_actions"].partition("AS z FROM s),")[2].rpartition("SELECT page_id, pos, action")[0] + "SELECT page_id, pos, type, md5(CASE action WHEN 'keep' THEN x ELSE z END) AS text_md5 FROM a WHERE action <> 'remove'"
SQL["sanitize_text_lines"] = f"{P} SELECT page_id, md5({clean_lines('content')}) AS cleaned_md5 FROM pages_"
NOTE = "> Warm intro mapping pending — Icebreaker MCP integration not yet configured. Manual warm intro research recommended."
# the section is the text's first, and its end is the first blank line before a heading
SQL["mcp_section_clean"] = rf"""{P}, r AS (SELECT page_id, '- x ' || content || e'\n\n## NEXT\nz\n' AS r FROM pages_), b AS (SELECT *, regexp_extract(r, '(?s)^(.*?\n)\n##\s', 1) AS body FROM r)
    SELECT page_id, md5(e'## INVESTOR WARM INTRO MAP\n' || CASE WHEN contains(body, 'mcp_unavailable') THEN '{NOTE}' || e'\n\n' || substr(r, length(body) + 1) ELSE r END) AS content_md5 FROM b"""
SQL["amount_band_pairs_customers"] = f"WITH l AS (SELECT c_custkey AS a, floor(c_acctbal)::BIGINT AS m FROM customer), r AS (SELECT p_partkey AS b, floor(p_retailprice)::BIGINT AS n FROM part) SELECT a, b FROM l, r WHERE m >= 0 AND {MATCH.format('m', 'n')}"
_only = r"regexp_matches(y, '^Search error: HTTPSConnectionPool|^\[Grok error:.*\]\z|^mcp_unavailable\z|^Traceback \(most recent call last\):|^requests\.exceptions\.|^HTTPSConnectionPool\(host=.*Max retries exceeded', 's')"
_issues = SQL["structure_issues"].partition("SELECT page_id, ")[2].rpartition(" AS issues FROM pages_")[0]
SQL["raw_scans"] = f"""WITH t AS (SELECT 'documents' AS source, doc_id::BIGINT AS id, coalesce(text, '') AS content FROM documents UNION ALL SELECT 'pages', page_id, coalesce(html, '') FROM pages UNION ALL SELECT 'benchmark', item_id, coalesce(text, '') FROM benchmark),
    s AS (SELECT *, {STRIP.format("content")} AS y, content AS x FROM t)
    SELECT source, id, len({HITS}) AS n_hits, array_to_string(({HITS})[1:3], '|') AS first_hits, y <> '' AND {_only} AS error_only, {" + ".join(count(m) for m in (OS, OE, HS, HE))} AS n_markers,
      {_issues} AS issues, md5({INTENDED}) AS section_md5, md5({_cleaned}) AS cleaned_md5 FROM s"""
SQL["amount_match_links"] = f"{D}, k AS (SELECT slug, amount, min(id) AS class_id, count(*) AS n FROM deals GROUP BY ALL), l AS (SELECT x.slug, x.amount, any_value(x.class_id) AS class_id, sum(y.n)::BIGINT - 1 AS n_links FROM k x JOIN k y ON x.slug = y.slug AND ({MATCH.format('x.amount', 'y.amount')}) GROUP BY x.slug, x.amount) SELECT id, class_id, n_links FROM deals JOIN l USING (slug, amount)"
SQL["page_by_id"] = f"{P} SELECT page_id, entry, type, source_skill, report_key, run_id FROM pages_ WHERE page_id = 7"


def _containing(which: str, column: str, kind: str) -> str:
    return f"""{P}, c AS (SELECT DISTINCT company FROM deals), e AS (SELECT {column} AS e, min(page_id) AS page_id, count(*) AS n FROM pages_ WHERE type = '{kind}' GROUP BY {column}),
        f AS (SELECT c.company, min(page_id) AS page_id, sum(n) AS n_pages FROM c JOIN e ON contains(e, c.company) GROUP BY c.company)
        SELECT id, page_id, coalesce(n_pages, 0)::BIGINT AS n_pages FROM deals LEFT JOIN f USING (company) {which}"""


SQL["outreach_page_exists"] = _containing("", "entry", "OUTREACH TARGET")
SQL["zero_amount_lookup"] = _containing("WHERE amount = 0", "company", "FUNDRAISING INTEL")
SQL["qa_write_back"] = f"""WITH {QA} SELECT page_id, CASE WHEN qa_status <> 'SKIP' THEN qa_status ELSE CASE page_id % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' END END AS qa_status,
    CASE WHEN qa_status <> 'SKIP' THEN qa_issues ELSE CASE page_id % 3 WHEN 1 THEN 'old' ELSE '' END END AS qa_issues, CASE WHEN qa_status <> 'SKIP' THEN '2026-03-08 12:00:00' ELSE '2026-01-01 00:00:00' END AS audited_at FROM qa"""
SQL["qa_stats_json"] = f"WITH {QA} SELECT '{{' || string_agg('\"' || s || '\":' || n, ',' ORDER BY k) || '}}' AS stats FROM (SELECT s, k, count(page_id) AS n FROM (VALUES ('PASS', 1), ('WARN', 2), ('FAIL', 3), ('SKIP', 4)) v(s, k) LEFT JOIN qa ON s = qa_status GROUP BY s, k)"
SQL["moved_dedup_notes"] = f"""{P}, n AS (SELECT page_id, entry, date, CASE WHEN page_id % 2 = 0 THEN 'old' END AS old,
      content || CASE page_id % 9 WHEN 1 THEN e'\\nArchived duplicate: x\\nend' WHEN 2 THEN e'\\n- Dedup cleanup' WHEN 3 THEN e'\\narchived duplicate: y' ELSE '' END AS c FROM pages_),
    l AS (SELECT *, string_split(c, e'\\n') AS ls FROM n), k AS (SELECT *, list_filter(ls, lambda x: NOT contains(x, 'Archived duplicate:') AND NOT contains(x, 'Dedup cleanup')) AS kept FROM l)
    SELECT page_id, md5(array_to_string(kept, e'\\n')) AS content_md5, CASE WHEN len(ls) > len(kept) THEN trim(coalesce(old, '') || e'\\nArchived: ' || entry || ' (' || strftime(date, '%Y-%m-%d') || ')', e' \\n') ELSE old END AS qa_issues, (len(ls) - len(kept))::BIGINT AS n_moved FROM k"""
SQL["tree_page_text"] = "SELECT conv_id AS page_id, md5(coalesce(string_agg(text, e'\\n' ORDER BY turn) FILTER (WHERE turn % 5 <> 4), '')) AS content_md5 FROM conversations GROUP BY conv_id"
SQL["tree_page_text_first_page"] = SQL["tree_page_text"].replace("turn % 5 <> 4", "turn % 5 <> 4 AND turn % 4 <> 3")
SQL["legacy_prefix_counts"] = f"""{P}, x AS (SELECT id, 'fundraising-intel:' || CASE WHEN id % 100 = 7 THEN 'v3' ELSE slug END || ':' AS prefix FROM deals),
n AS (SELECT prefix, count(report_key) AS n_keys FROM (SELECT DISTINCT prefix FROM x) LEFT JOIN pages_ ON starts_with(report_key, prefix) GROUP BY prefix) SELECT id, n_keys FROM x JOIN n USING (prefix)"""
SQL["near_slugs"] = f"""{D}, s AS (SELECT slug, count(*) AS n_rows FROM deals WHERE slug IS NOT NULL GROUP BY slug),
p AS (SELECT a.slug, b.n_rows AS m FROM s a JOIN s b ON a.slug <> b.slug AND levenshtein(a.slug, b.slug) <= 1)
SELECT slug, any_value(n_rows) AS n_rows, count(m) AS n_near, coalesce(sum(m), 0)::BIGINT AS n_near_rows FROM s LEFT JOIN p USING (slug) GROUP BY slug"""
SQL["paged_calls"] = "SELECT user_id % 4 AS service, count(*) AS n_failed, max(event_id) AS last_id FROM events WHERE event_type = 'error' AND event_id >= 500 AND user_id % 4 < 3 GROUP BY 1"
SQL["raw_properties"] = """WITH e AS (SELECT event_id, CASE event_id % 7 WHEN 1 THEN '{"k": null}' WHEN 2 THEN replace(replace(props, ': ', ': "'), '}', '"}') WHEN 3 THEN '{' || props WHEN 4 THEN '{}' WHEN 5 THEN NULL ELSE props END AS raw FROM events),
t AS (SELECT event_id, CASE WHEN raw IS NULL THEN 'none' WHEN NOT json_valid(raw) THEN 'malformed' ELSE CASE json_type(CASE WHEN json_valid(raw) THEN raw END, '$.k') WHEN 'NULL' THEN 'null' WHEN 'UBIGINT' THEN 'ok' WHEN 'BIGINT' THEN 'ok' WHEN 'VARCHAR' THEN 'type' ELSE 'missing' END END AS state, raw FROM e)
SELECT event_id, state, CASE WHEN state = 'ok' THEN json_extract_string(raw, '$.k')::BIGINT END AS value FROM t"""
_LATEST = "FROM x WHERE early = {0} QUALIFY row_number() OVER (PARTITION BY report_key ORDER BY seen_at DESC, id DESC) = 1"
SQL["upserted_pages"] = f"""{D}, x AS (SELECT report_key, id, amount, seen_at, seen_at < TIMESTAMP '1995-06-01' AS early FROM deals), e AS (SELECT * {_LATEST.format("true")}), l AS (SELECT * {_LATEST.format("false")})
SELECT coalesce(l.report_key, e.report_key) AS report_key, coalesce(l.id, e.id) AS page_id, e.amount, CASE WHEN l.id IS NOT NULL THEN 'PASS' END AS qa_status FROM e FULL JOIN l ON e.report_key = l.report_key"""
_DEEP = """deep AS (SELECT event_id % 4 AS page_id, event_id AS block_id, CASE WHEN event_id // 4 = 0 THEN NULL WHEN event_id // 4 % 5 = 0 THEN event_id - 20 ELSE event_id - 4 * (event_id // 4 % 5) END AS parent_id,
  CASE WHEN event_id // 4 % 5 = 0 THEN 2 ELSE event_id // 4 % 5 END AS pos, CASE WHEN event_id % 7 <> 3 THEN event_type || ' ' || event_id END AS text FROM events)"""
SQL["deep_tree_text"] = f"""WITH RECURSIVE {_DEEP},
tree AS (SELECT page_id, block_id, text, [(pos, block_id)] AS path FROM deep WHERE parent_id IS NULL UNION ALL SELECT d.page_id, d.block_id, d.text, list_append(path, (d.pos, d.block_id)) FROM tree t JOIN deep d ON d.page_id = t.page_id AND d.parent_id = t.block_id),
silent AS (SELECT page_id, parent_id FROM deep d WHERE parent_id IS NOT NULL GROUP BY ALL HAVING bool_and(text IS NULL AND NOT EXISTS (SELECT 1 FROM deep c WHERE c.page_id = d.page_id AND c.parent_id = d.block_id))),
lines AS (SELECT page_id, path, text FROM tree WHERE text IS NOT NULL UNION ALL SELECT page_id, list_append(path, (99, 0)), '' FROM tree SEMI JOIN silent ON silent.page_id = tree.page_id AND silent.parent_id = tree.block_id)
SELECT r.page_id, md5(coalesce(string_agg(l.text, chr(10) ORDER BY path), '')) AS content_md5 FROM (SELECT DISTINCT page_id FROM tree) r LEFT JOIN lines l USING (page_id) GROUP BY r.page_id"""
SQL["unread_tree_blocks"] = f"""WITH RECURSIVE {_DEEP}, b AS (SELECT page_id, block_id, CASE WHEN block_id // 4 = 15 THEN block_id + 20 ELSE parent_id END AS parent_id FROM deep WHERE block_id % 400 <> 201),
up AS (SELECT page_id, block_id, parent_id, 0 AS steps FROM b UNION ALL SELECT u.page_id, u.block_id, p.parent_id, steps + 1 FROM up u JOIN b p ON p.page_id = u.page_id AND p.block_id = u.parent_id WHERE steps < (SELECT count(*) / 4 + 4 FROM b)),
last AS (SELECT page_id, block_id, arg_max(parent_id, steps) AS top, max(steps) AS steps, bool_or(parent_id IS NULL) AS ended FROM up GROUP BY ALL)
SELECT page_id, CASE WHEN steps >= (SELECT count(*) / 4 + 4 FROM b) THEN 'cycle' ELSE 'orphan' END AS reason, count(*) AS n_blocks, min(block_id) AS first_block FROM last WHERE NOT ended GROUP BY ALL"""
SQL["text_properties"] = f"""SELECT conv_id, turn, md5(CASE WHEN conv_id % 5 < 2 THEN {STRIP.format("' ' || role || CASE WHEN turn % 2 = 0 THEN ': ' ELSE '' END || coalesce(text, '')")} WHEN conv_id % 5 = 2 AND turn % 3 > 0 THEN role ELSE '' END) AS value_md5 FROM conversations"""
SQL["page_properties_poc"] = f"{D} SELECT id, company || ' — ' || ({FORMAT.format('amount')}) || ' ' || round_type || ' | FUNDING INTEL | MAR 8, 2026' AS entry, 'PASS' AS qa_status, CASE id % 3 WHEN 1 THEN 'user-' || id WHEN 2 THEN 'a|b' || id END AS poc FROM deals"
SQL["preset_breaker_states"] = (
    SQL["breaker_states"].replace("user_id % 4 AS service", "['duckduckgo', 'grok', 'icebreaker', 'other'][user_id % 4 + 1] AS service")
    .replace("fails + 1 >= 2 END", "fails + 1 >= CASE service WHEN 'icebreaker' THEN 2 ELSE 3 END END").replace("o.t - w.last >= 1800", "o.t - w.last >= CASE w.service WHEN 'duckduckgo' THEN 600 WHEN 'icebreaker' THEN 900 ELSE 300 END")
)
