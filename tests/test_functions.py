import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsieve.functions import amounts, entities, keys, text
from recsieve.operators import blocks, dedup, qa, trees
from recsieve.operators import resilience as R


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").select("i", f(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(rows)]


def test_parse_amount(spark):
    cases = {
        "$31M": 31000000, "$4.25M": 4250000, "$1.5B": 1500000000, "31m": 31000000, "750K": 750000, "$2,500": 2500, "$ 31 M": 31000000, "$4.1M": 4099999, "": 0, None: 0, "undisclosed": 0,
        "$31 million": 0, "31bn": 0, "31MM": 0, "US$31M": 0, "block": 0, "$B": 0, "-$5M": -5000000, "1e3": 1000, "1_000": 1000, "nan": 0, "inf": 0, "31d": 0, "31f": 0, "1e400": 0,
    }
    assert column(spark, list(cases), amounts.parse_amount) == list(cases.values())


def test_format_amount_is_exact(spark):
    def shown(a):
        if a >= 1e9:
            return f"${a / 1e9:.1f}B"
        if a >= 1e6:
            return f"${a // 1000000}M" if a % 1000000 == 0 else f"${a / 1e6:.1f}M"
        return f"${a / 1e3:.0f}K" if a >= 1000 else f"${a}" if a > 0 else "$0"

    rng = np.random.default_rng(1)
    values = [0, -5, 999, 1500, 2500, 999999, 4250000, 4350000, 999950000, 25000000000]
    values += [int(x) * 50000 for x in rng.integers(20, 20000, 3000)] + [int(x) * 50000000 for x in rng.integers(20, 4_000_000, 3000)] + [int(x) * 500 for x in rng.integers(1, 2000, 500)] + [int(x) for x in rng.integers(0, 10**13, 2000)]
    assert column(spark, values, amounts.format_amount, "long") == [shown(v) for v in values]


def test_amounts_match(spark):
    pairs = [(4200000, 4250000, True), (0, 0, True), (0, 8180000, False), (100, 95, True), (100, 94, False), (-5, -100, True), (-5, 5, False)]
    df = spark.createDataFrame(pairs, "a long, b long, y boolean")
    assert df.where(amounts.amounts_match(F.col("a"), F.col("b")) != F.col("y")).count() == 0


def test_slugs_and_keys(spark):
    cases = {"CROSSOVER MARKETS": "crossover-markets", "USD.AI": "usdai", "USD AI": "usd-ai", "Foo -- Bar": "foo-bar", "A_B": "ab", "-x-": "x", "A\tB": "a-b", "Éclair": "clair", "日本": "", "  a b ": "a-b"}
    assert column(spark, list(cases), keys.slugify) == list(cases.values())
    found = column(spark, ["fundraising-intel:v3:acme:8000000", "fundraising-intel:acme:2026-03-05", "signal-pack:v1:2026-03-08", "outreach-intel:acme:8000000", "", None], keys.parse_key)
    assert [tuple(x) for x in found] == [("v3", "acme", "8000000"), ("legacy", "acme", "2026-03-05"), ("pack", None, "2026-03-08"), ("outreach", "acme", "8000000"), ("none", None, None), ("none", None, None)]


def test_investors(spark):
    raw = ["Visa", "visa ", "Stripe", "(co-founder", "Cyclops)", "Jane Roe (CEO/co-founder", "Acme Fund (NY)", "Vector Capital (NY)", "Founder Collective", "Partner", "President Capital", ""]
    assert column(spark, [raw, ["Jane Roe"], []], entities.clean_investors, "array<string>") == [["Visa", "Stripe", "Acme Fund (NY)"], ["Jane Roe"], []]
    assert column(spark, [raw], lambda c: entities.clean_investors(c, "spec"), "array<string>") == [["Visa", "visa", "Stripe", "Founder Collective", "Partner", "President Capital", ""]]


TIMEOUT = "Search error: HTTPSConnectionPool(host='html.duckduckgo.com', port=443): Max retries exceeded"


def test_sanitize(spark):
    cases = {
        f"good\n{TIMEOUT}\nmore": "",
        "good\nSearch error: HTTPSConnectionPool(host='other') x\nmore": "good\n[Search unavailable — service timeout.]\nmore",
        "good\n[Grok error: quota] tail": "good\n[Analysis unavailable — API timeout. Manual review recommended.] tail",
        "good\n[Grok error: HTTPSConnectionPool(host='api.x.ai', port=443): Read timed out.]": "",
        "a\nrequests.exceptions.ReadTimeout: b": "a\nrequests.exceptions.ReadTimeout: b",
        "a\nTraceback (most recent call last):\n  File x\nValueError: boom\nz": "a\n\nValueError: boom\nz",
        "x\n- Status: mcp_unavailable\n- Notes: Icebreaker MCP URL not configured.\nkeep": "x\n- Status: Pending — Icebreaker integration not yet configured.",
        "a\n\n\n\nb": "a\n\nb", "mcp_unavailable": "mcp_unavailable",
    }
    got = column(spark, list(cases), text.sanitize_text)
    assert got == list(cases.values())
    assert column(spark, got, text.sanitize_text) == got
    assert column(spark, [f"good\n{TIMEOUT}\nmore"], lambda c: text.sanitize_text(c, "line")) == ["good\nmore"]


def test_error_only(spark):
    cases = {"mcp_unavailable": True, "[Grok error: x] good text [y]": True, "Traceback (most recent call last):\n  a\ngood": True, "": False, "see mcp_unavailable": False, " requests.exceptions.X": True, "Search error: HTTPSConnectionPool a\nb": True}
    assert column(spark, list(cases), text.error_only) == list(cases.values())


def test_map_section(spark):
    head = "## INVESTOR WARM INTRO MAP\n"

    def plain(s):
        body = lambda m: m[1] + text.MAP_NOTE if "mcp_unavailable" in m[2] else m[0]
        return re.sub(r"(##\s*.*INVESTOR.*WARM INTRO MAP.*\n)((?:.*\n)*?)(?=\n##\s|\Z)", body, s, flags=re.M) if "mcp_unavailable" in s else s

    cases = [head + "- mcp_unavailable\n\n## NEXT\nz\n", head + "- mcp_unavailable\n## NEXT\nz\n", head + "- mcp_unavailable\n## NEXT\nz", "a\n" + head + "ok\n\n## B\n" + head + "mcp_unavailable\n", "no", "mcp_unavailable\n" + head + "fine\n"]
    assert column(spark, cases, text.clean_map_sections) == [plain(c) for c in cases]


def test_sections_and_markers(spark):
    page = "x\n# INVESTORS\n- a\n- b\n\n## Next\nz"
    assert column(spark, [page, "# investors", "none"], lambda c: text.section(c, "INVESTORS")) == ["- a\n- b", "", None]
    assert column(spark, [page, page + "\n", "none"], lambda c: text.section_literal(c, "INVESTORS")) == ["z", "", None]
    marked = f"a {qa.HIRING[0]}old{qa.HIRING[1]} z"
    once = column(spark, [marked, "none"], lambda c: text.replace_between(c, *qa.HIRING, "new $1"))
    assert once == [f"a {qa.HIRING[0]}\nnew $1\n{qa.HIRING[1]} z", "none"]
    assert column(spark, once, lambda c: text.replace_between(c, *qa.HIRING, "new $1")) == once


def test_qa_matrix(spark):
    L, (os_, oe), (hs, he) = "y" * 600, qa.OUTREACH, qa.HIRING
    M = os_ + oe + hs + he
    full = dict(entry="t", type="FUNDRAISING INTEL", source_skill="s", report_key="k", run_id="r", content=M + L)
    cases = [
        ({}, "PASS", 0), ({"report_key": ""}, "FAIL", 1), ({"content": os_ + hs + he + L}, "FAIL", 1), ({"content": os_ + oe + he + L}, "FAIL", 2), ({"content": L}, "WARN", 2), ({"content": os_ + oe + M + L}, "FAIL", 1),
        ({"content": M + L + "mcp_unavailable mcp_unavailable"}, "FAIL", 2), ({"content": M}, "WARN", 1), ({"source_skill": None, "run_id": ""}, "WARN", 2), ({"type": "SIGNAL PACK", "content": "signal"}, "WARN", 2),
        ({"type": "OUTREACH TARGET", "content": None}, "PASS", 0), ({"entry": "[archived] x", "report_key": ""}, "SKIP", 0), ({"content": M + L + " TIMEOUTERROR timeouterror"}, "FAIL", 1), ({"content": M + L + "\n# INVESTORS\n- a\n- b\n- c"}, "WARN", 1),
        ({"content": M + L + "\n# INVESTORS\n- a\n- b\n- c\n"}, "PASS", 0),
    ]
    rows = [(i, *({**full, **change}[k] for k in full)) for i, (change, _, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "page_id int, " + ", ".join(f"{k} string" for k in full))
    for mode in ("literal", "intended"):
        got = {r.page_id: r for r in qa.validate_pages(df, mode).collect()}
        for i, (_, status, n) in enumerate(cases):
            if mode == "intended" and i == 13:
                status, n = "PASS", 0
            assert got[i].qa_status == status, i
            assert (0 if got[i].qa_issues in ("", "All checks passed.") else len(got[i].qa_issues.split(" | "))) == n, i
    assert {r.qa_status: r.n_pages for r in qa.status_histogram(qa.validate_pages(df)).collect()} == {"PASS": 3, "WARN": 5, "FAIL": 6, "SKIP": 1}
    assert column(spark, ["", "Investors: x"], lambda c: F.size(qa.structure_issues(c))) == [7, 6]


def test_template_blocks(spark):
    for n, m, total in ((0, 0, 18), (2, 1, 19), (0, 3, 20)):
        df = spark.createDataFrame([("Acme", 31000000, "Seed", [f"i{x}" for x in range(n)], [f"u{x}" for x in range(m)])], "c string, a long, r string, i array<string>, s array<string>")
        b = df.select(blocks.canonical_blocks(F.col("c"), F.col("a"), F.col("r"), F.col("i"), F.col("s")).alias("b")).first().b
        assert len(b) == total
        content = "\n".join(x.text or "" for x in b)
        assert spark.createDataFrame([(content,)], "x string").select(qa.structure_issues(F.col("x")).alias("y")).first().y == []


def test_greedy_and_band(spark):
    df = spark.createDataFrame([(1, "a", 1, 100), (2, "a", 2, 104), (3, "a", 3, 108), (4, "a", 4, 0), (5, "a", 5, 0)], "id long, slug string, seen_at int, amount long")
    assert {r.id: r.canonical_id for r in dedup.greedy_dedup(df, "slug").collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
    rng = np.random.default_rng(4)
    a, b = [int(x) for x in rng.integers(0, 3000, 300)], [int(x) for x in rng.integers(0, 3000, 300)]
    got = dedup.band_pairs(spark.createDataFrame(list(enumerate(a)), "a int, amount_a long"), spark.createDataFrame(list(enumerate(b)), "b int, amount_b long"))
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if (x == y if 0 in (x, y) else abs(x - y) / max(x, y) <= 0.05)}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_breaker_traces(spark):
    trace = [(0, False), (10, False), (20, False), (319, True), (320, False), (619, True), (620, True)]
    df = spark.createDataFrame([("s", float(t), i, ok) for i, (t, ok) in enumerate(trace)], "service string, t double, id long, ok boolean")
    log = {r.id: (r.allowed, r.fails, r.state) for r in R.breaker_log(df, 3, 300.0).collect()}
    assert log == {0: (True, 1, "closed"), 1: (True, 2, "closed"), 2: (True, 3, "open"), 3: (False, 3, "open"), 4: (True, 4, "open"), 5: (False, 4, "open"), 6: (True, 0, "closed")}
    waits = spark.createDataFrame([(2, 2.0), (1, 3.0), (0, 1.0)], "n int, b double").select(R.backoff(F.col("n"), F.col("b")).alias("w")).collect()
    assert [r.w for r in waits] == [[2.0, 4.0], [3.0], []]


@pytest.mark.parametrize("mode", ["literal", "line"])
def test_empty_tables(spark, mode):
    df = spark.createDataFrame([], "page_id long, pos int, text string")
    assert blocks.block_actions(df, mode=mode).count() == 0
    assert blocks.page_text(df).count() == 0


def test_greedy_against_a_plain_fold(spark):
    rng = random.Random(5)
    amounts = [None, 0, 1, 20, 21, 22, 23, 24, 100, 104, 108, 112, -5, -9, 10**9, int(1.04 * 10**9)]
    rows = [(i, rng.choice(["x", "y", None]), rng.randrange(40), rng.choice(amounts)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, slug string, seen_at int, amount long")
    match = lambda a, b: a is not None and b is not None and (a == b if 0 in (a, b) else abs(a - b) / max(a, b) <= 0.05)
    want, canon = {}, {}
    for i, slug, _, amount in sorted(rows, key=lambda r: (r[2], r[0])):
        known = canon.setdefault(slug, [])
        want[i] = next((c for c, a in known if match(a, amount)), i)
        if want[i] == i:
            known.append((i, amount))
    assert {r.id: r.canonical_id for r in dedup.greedy_dedup(df, "slug").collect()} == want
    assert dedup.greedy_dedup(df.where("false"), "slug").count() == 0


def test_contains_by_parts_is_the_broadcast_join(spark):
    names = spark.createDataFrame([(1, "Acme Corp"), (2, "the ACME"), (3, ""), (4, None), (5, "é Straße"), (6, "corp acm")], "id int, name string")
    needles = spark.createDataFrame([("acme",), ("corp",), ("",), (None,), ("straße",), ("zz",), ("c",)], "needle string")
    show = lambda **k: sorted(map(tuple, dedup.contains_pairs(names, needles, **k).collect()))
    assert show() == show(most=0) and (1, "acme") in show() and (3, "") in show()
    assert show(any_case=False) == show(any_case=False, most=0) and (2, "acme") not in show(any_case=False)


def test_breaker_sessions_and_presets(spark):
    rng = random.Random(3)
    t, rows = 0.0, []
    for i in range(3000):
        t += rng.choice([1, 1, 5, 200, 301, 900])
        rows.append((rng.choice(["grok", "icebreaker", "x", None]), t, i, rng.random() < 0.5))
    df = spark.createDataFrame(rows, "service string, t double, id long, ok boolean")
    want, state, limits = {}, {}, {"grok": (3, 300), "icebreaker": (2, 900)}
    for s, at, i, ok in rows:
        most, wait = limits.get(s, (3, 300))
        fails, last, is_open = state.get(s, (0, 0.0, False))
        allowed = not is_open or at - last >= wait
        if allowed:
            fails, last = (0, last) if ok else (fails + 1, at)
            is_open = fails >= most
        state[s] = (fails, last, is_open)
        want[i] = (allowed, fails, "open" if is_open else "closed")
    assert {r.id: (r.allowed, r.fails, r.state) for r in R.preset_breaker_log(df).collect()} == want
    assert [tuple(r) for r in R.breakers(spark).collect()] == R.BREAKERS
    logs = [{r.id: (r.allowed, r.fails, r.state) for r in R.breaker_log(df, 3, 300.0, slice_s=w).collect()} for w in (0.5, 10.0, 450.0, 1e9)]
    assert all(log == logs[0] for log in logs) and {i: x for i, x in logs[0].items() if rows[i][0] in ("grok", "x")} == {i: x for i, x in want.items() if rows[i][0] in ("grok", "x")}
    assert R.breaker_log(df.where("false"), 3, 300.0).count() == 0
    runs, length = [], {}
    for s, _, i, ok in rows:
        if ok:
            length.pop(s, None)
        elif s in length:
            runs[length[s]][2] += 1
        else:
            length[s] = len(runs)
            runs.append([s, i, 1])
    for width in (10.0, 3600.0):
        assert sorted(map(str, map(tuple, R.failure_runs(df, width).collect()))) == sorted(str(tuple(r)) for r in runs)


def test_write_back_and_hook(spark):
    rows = [(1, "a", "OUTREACH TARGET", "s", "k", "r", "x"), (2, "[Archived] b", "OUTREACH TARGET", "s", "", "r", "x"), (3, "c", "OUTREACH TARGET", "", "k", "r", None)]
    df = spark.createDataFrame(rows, "page_id int, entry string, type string, source_skill string, report_key string, run_id string, content string")
    out = {r.page_id: r for r in qa.audited(df, F.lit("2026-01-02").cast("timestamp")).collect()}
    assert [out[i].qa_status for i in (1, 2, 3)] == ["PASS", None, "WARN"] and out[2].last_audited_at is None and out[3].last_audited_at is not None
    again = qa.audited(qa.audited(df, F.lit("2026-01-02").cast("timestamp")), F.lit("2026-01-03").cast("timestamp"))
    assert again.columns == [*df.columns, "qa_status", "qa_issues", "last_audited_at"]
    assert [qa.post_write_hook(df, i) for i in (1, 2, 3, 4)] == ["PASS", "SKIP", "WARN", None]
    assert qa.status_json(qa.status_histogram(qa.validate_pages(df))).first().stats == '{"PASS":1,"WARN":1,"FAIL":0,"SKIP":1}'


def test_moved_notes_and_properties(spark):
    rows = [("t", "a\nArchived duplicate: x\nb", None), ("t", "a", None), ("t", None, "old"), ("t", "Dedup cleanup", "old")]
    df = spark.createDataFrame(rows, "entry string, content string, qa_issues string")
    got = [(r.content, r.qa_issues, r.n_moved) for r in blocks.moved_notes(df, F.lit("2026-01-01")).collect()]
    assert got == [("a\nb", "Archived: t (2026-01-01)", 1), ("a", None, 0), (None, "old", 0), ("", "old\nArchived: t (2026-01-01)", 1)]
    props = [("rich_text", [(" a",), (None,), ("b ",)], None), ("title", None, None), ("select", None, "n"), ("select", None, None), ("number", [("x",)], "n"), None]
    assert column(spark, props, blocks.text_property, "struct<type:string,spans:array<struct<plain_text:string>>,name:string>")[:5] == ["a" + "b", "", "n", "", ""]


def test_tree_text(spark):
    rows = [("p", 1, None, 0, "root"), ("p", 2, 1, 1, "child"), ("p", 3, 2, 2, None), ("p", 4, 3, 3, "deep"), ("p", 5, 1, 4, ""), ("p", 6, None, 5, "last"), ("q", 1, None, 0, None)]
    df = spark.createDataFrame(rows, "page_id string, block_id int, parent_id int, pos int, text string")
    show = lambda *a: {r.page_id: r.content for r in trees.tree_text(df, *a).collect()}
    assert show() == {"p": "root\nchild\ndeep\n\nlast", "q": ""}
    assert show(1) == {"p": "root\nchild\ndeep\nlast", "q": ""}


def test_command_line(spark, tmp_path):
    from recsieve import cli
    from recsieve.sources import tables as T

    T.blocks(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/blocks")
    T.pages(spark, "/root/testdata/sf0.001").limit(50).write.parquet(f"{tmp_path}/pages")
    one = str(spark.read.parquet(f"{tmp_path}/pages").first().page_id)
    assert cli.main(["validate", f"{tmp_path}/pages"], spark) == 1 and cli.main(["clean", f"{tmp_path}/blocks", "--recent", "3"], spark) == 1
    assert cli.main(["validate", f"{tmp_path}/pages", "--page-id", one, "--out", f"{tmp_path}/out"], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/out").select("page_id", "qa_status").count() == 1
    assert cli.main(["validate", f"{tmp_path}/pages", "--recent", "24", "--out", f"{tmp_path}/none", "--dry-run"], spark) == 0
    assert not (tmp_path / "none").exists()
    assert cli.main(["clean", f"{tmp_path}/blocks", "--page-id", "3", "--out", f"{tmp_path}/clean"], spark) == 0
