"""The queries of the record engine by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsieve.functions import amounts, entities, keys, properties, text
from recsieve.operators import blocks as B
from recsieve.operators import dedup, names, qa, trees
from recsieve.operators import resilience as R
from recsieve.plans.oracle import SQL
from recsieve.sources import paged
from recsieve.sources import tables as T
from recsieve.sources.staging import checkpoint_dir
from recsieve.sources.stored import StoredTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
NOW = "2026-03-08 12:00:00"
THRESHOLD, RESET = 2, 1800.0


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def upper(df: DataFrame) -> DataFrame:
    """With the content in upper case as `up`: a projection of its own, computed once however many rules look at it."""
    return df.withColumn("up", F.upper("content"))


def joined(c, sep: str = "|"):
    return F.array_join(c, sep)


@query
def dup_key_clusters(spark, sf_dir):
    d = T.deals(spark, sf_dir)
    return d.groupBy("report_key").agg(F.count("*").alias("n"), F.min("id").alias("first_id")).where("n > 1")


@query
def slug_key(spark, sf_dir):
    return T.deals(spark, sf_dir).select("id", "slug", "report_key")


@query
def part_slugs(spark, sf_dir):
    p = T.table(spark, sf_dir, "part")
    name = F.concat(F.lit("\t-"), F.initcap("p_name"), F.lit("_x -- É"), F.col("p_brand"), F.lit("-  "))
    return p.select("p_partkey", keys.slugify(name).alias("slug"))


@query
def legacy_outreach_pack_keys(spark, sf_dir):
    d = T.deals(spark, sf_dir)
    company = F.col("company")
    return d.select("id", keys.legacy_key(company, F.col("seen_at")).alias("legacy"), keys.legacy_prefix(company).alias("prefix"), keys.outreach_key(company, F.col("amount")).alias("outreach"), keys.pack_key(F.col("seen_at")).alias("pack"))


@query
def parsed_keys(spark, sf_dir):
    return T.page_rows(spark, sf_dir).select("page_id", keys.parse_key(F.col("report_key")).alias("k")).select("page_id", "k.scheme", "k.slug", "k.suffix")


@query
def key_schemes(spark, sf_dir):
    """How many pages have a key of each scheme, and how many companies have keys of several."""
    p = T.page_rows(spark, sf_dir).select("slug", keys.parse_key(F.col("report_key"))["scheme"].alias("scheme"))
    schemes = ["v3", "legacy", "pack", "outreach", "none"]
    own = p.groupBy("slug").agg(*(F.count_if(F.col("scheme") == s).alias(s) for s in schemes))
    several = sum((F.col(s) > 0).cast("int") for s in schemes[:-1]) > 1
    total = own.agg(*(F.sum(s).alias(s) for s in schemes), F.count_if(several).alias("several"))
    rows = F.array(*(F.struct(F.lit(s).alias("scheme"), F.col(s).alias("n")) for s in [*schemes, "several"]))
    return total.select(F.explode(rows).alias("x")).select("x.*").where("n > 0 or scheme = 'several'")


@query
def parse_amount(spark, sf_dir):
    return T.deals(spark, sf_dir).select("id", "amount_str", "amount")


def _shown(spark, sf_dir):
    """Amounts of all sizes, many of them halfway between two displayed values."""
    a = "floor(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1D WHEN 1 THEN 100D WHEN 2 THEN 10000D ELSE 0.001D END)"
    n = F.expr(a).cast("long")
    step = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 4 = 2 THEN 50000000 WHEN o_orderkey % 4 = 1 THEN 50000 ELSE 500 END").cast("long")
    return T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (n - n % step).alias("amount"))


@query
def format_amount(spark, sf_dir):
    return _shown(spark, sf_dir).select("id", "amount", amounts.format_amount(F.col("amount")).alias("shown"))


@query
def page_properties(spark, sf_dir):
    d = T.deals(spark, sf_dir)
    return d.select("id", *B.page_properties(F.col("company"), F.col("amount"), F.col("round_type"), F.col("run_id"), F.lit(NOW).cast("timestamp")))


@query
def amount_match_pairs(spark, sf_dir):
    return dedup.tolerance_pairs(T.deals(spark, sf_dir), "slug")


@query
def amount_band_pairs(spark, sf_dir):
    """Suppliers' balances, without their signs, against parts' prices: a join on the tolerance alone."""
    l = T.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("a"), F.floor(F.abs("s_acctbal")).cast("long").alias("amount_a"))  # noqa: E741
    r = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("b"), F.floor("p_retailprice").cast("long").alias("amount_b"))
    return dedup.band_pairs(l, r)


@query
def amount_band_pairs_customers(spark, sf_dir):
    """Customers' balances as they are, negative ones too, against parts' prices."""
    l = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("a"), F.floor("c_acctbal").cast("long").alias("amount_a"))  # noqa: E741
    r = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("b"), F.floor("p_retailprice").cast("long").alias("amount_b"))
    return dedup.band_pairs(l, r)


@query
def amount_conflicts(spark, sf_dir):
    """Records whose amounts of one day and company spread beyond the tolerance."""
    d = T.deals(spark, sf_dir).where("amount > 0").groupBy("slug", F.year("seen_at").cast("long").alias("year"))
    return d.agg(F.min("amount").alias("low"), F.max("amount").alias("high"), F.count_distinct("amount").alias("n_amounts")).where(~amounts.amounts_match(F.col("low"), F.col("high")))


@query
def canonical_pick(spark, sf_dir):
    p = T.page_rows(spark, sf_dir).select("slug", "page_id", "report_key", "date", keys.parse_key(F.col("report_key")).alias("k"))
    first = [F.when(F.col("k.scheme") == "v3", 0).otherwise(1), F.when(F.coalesce(F.col("k.suffix"), F.lit("0")) != "0", 0).otherwise(1), F.col("date"), F.col("page_id")]
    return dedup.canonical_pick(p, "slug", first).select("slug", "page_id", "report_key")


@query
def legacy_or_v3_lookup(spark, sf_dir):
    d = T.deals(spark, sf_dir)
    p = T.page_rows(spark, sf_dir).withColumn("k", keys.parse_key(F.col("report_key"))).select("page_id", "report_key", "k.scheme", "k.slug")
    return dedup.key_lookup(d, p)


@query
def zero_amount_guard(spark, sf_dir):
    return dedup.zero_amount_guard(T.deals(spark, sf_dir), T.page_rows(spark, sf_dir).where("type = 'FUNDRAISING INTEL'"))


def _canonicals(spark, sf_dir):
    return T.page_rows(spark, sf_dir).where("type = 'FUNDRAISING INTEL'").select("slug")


@query
def canonical_missing(spark, sf_dir):
    return dedup.missing(T.deals(spark, sf_dir), _canonicals(spark, sf_dir), ["slug"]).select("id", "slug")


@query
def canonical_present(spark, sf_dir):
    return dedup.present(T.deals(spark, sf_dir), _canonicals(spark, sf_dir), ["slug"]).select("id", "slug")


@query
def outreach_pairs(spark, sf_dir):
    """Outreach pages beside a canonical page of their company."""
    p = T.page_rows(spark, sf_dir)
    one = p.where("type = 'FUNDRAISING INTEL'").groupBy("slug").agg(F.min("page_id").alias("canonical_id"), F.count("*").alias("n_canonical"))
    return p.where("type = 'OUTREACH TARGET'").join(one, "slug").select("page_id", "canonical_id", "n_canonical")


@query
def company_contains(spark, sf_dir):
    n = T.table(spark, sf_dir, "nation").select(F.lower("n_name").alias("needle"))
    c = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string"), F.lit(" "), F.col("c_name")).alias("name"))
    return dedup.contains_pairs(c, n)


@query
def greedy_dedup(spark, sf_dir):
    return dedup.greedy_dedup(T.deals(spark, sf_dir), "slug").select("id", "canonical_id")


@query
def error_hits(spark, sf_dir):
    hits = text.error_hits(F.col("content"), F.col("up"))
    return upper(T.pages(spark, sf_dir)).select("page_id", F.size(hits).cast("long").alias("n_hits"), joined(F.slice(hits, 1, 3)).alias("first_hits"))


@query
def error_only(spark, sf_dir):
    return T.blocks(spark, sf_dir).select("page_id", "pos", F.coalesce(text.error_only(F.col("text")), F.lit(False)).alias("error_only"))


@query
def marker_counts(spark, sf_dir):
    c = F.col("content")
    names = {"outreach_start": qa.OUTREACH[0], "outreach_end": qa.OUTREACH[1], "hiring_start": qa.HIRING[0], "hiring_end": qa.HIRING[1]}
    return T.pages(spark, sf_dir).select("page_id", *(text.occurrences(c, m).alias(n) for n, m in names.items()))


@query
def dedup_notes(spark, sf_dir):
    """Pages whose body has a note that belongs in their issues."""
    note = F.expr("CASE page_id % 9 WHEN 1 THEN '\\nArchived duplicate: x' WHEN 2 THEN '\\n- Dedup cleanup' WHEN 3 THEN '\\narchived duplicate: y' ELSE '' END")
    return T.pages(spark, sf_dir).where(text.has_dedup_note(F.concat("content", note))).select("page_id", "entry")


@query
def structure_issues(spark, sf_dir):
    return upper(T.pages(spark, sf_dir)).select("page_id", joined(qa.structure_issues(F.col("content"), F.col("up"))).alias("issues"))


@query
def qa_issues(spark, sf_dir):
    return qa.validate_pages(T.pages(spark, sf_dir)).select("page_id", "qa_status", "qa_issues")


@query
def qa_issues_intended(spark, sf_dir):
    """With sections read up to the next heading."""
    return qa.validate_pages(T.pages(spark, sf_dir), "intended").select("page_id", "qa_status", "qa_issues")


@query
def qa_status_histogram(spark, sf_dir):
    return qa.status_histogram(qa.validate_pages(T.pages(spark, sf_dir)))


@query
def archived_skip(spark, sf_dir):
    return T.page_rows(spark, sf_dir).where(qa.archived(F.col("entry"))).select("page_id", "entry")


@query
def recent_pages(spark, sf_dir):
    cut = F.lit("1998-10-03 00:00:00").cast("timestamp_ntz") - F.expr("INTERVAL 720 HOURS")
    return T.page_rows(spark, sf_dir).where(F.col("date") > cut).orderBy(F.desc("date"), "page_id").select("page_id", "date")


@query
def investor_section_literal(spark, sf_dir):
    return upper(T.pages(spark, sf_dir)).select("page_id", text.section_literal(F.col("content"), "INVESTORS", F.col("up")).alias("section"))


@query
def investor_section_intended(spark, sf_dir):
    return T.pages(spark, sf_dir).select("page_id", text.section(F.col("content"), "INVESTORS").alias("section"))


@query
def sanitize_text(spark, sf_dir):
    return T.pages(spark, sf_dir).select("page_id", F.md5(text.sanitize_text(F.col("content"))).alias("cleaned_md5"))


@query
def sanitize_text_lines(spark, sf_dir):
    return T.pages(spark, sf_dir).select("page_id", F.md5(text.sanitize_text(F.col("content"), "line")).alias("cleaned_md5"))


@query
def raw_scans(spark, sf_dir):
    """Whole documents, pages and benchmark through the scanners unchanged."""
    c = F.col("content")
    hits, up = text.error_hits(c, F.col("up")), F.col("up")
    n_markers = sum(text.occurrences(c, m) for m in (*qa.OUTREACH, *qa.HIRING))
    return upper(T.raw_texts(spark, sf_dir)).select(
        "source", "id", F.size(hits).cast("long").alias("n_hits"), joined(F.slice(hits, 1, 3)).alias("first_hits"), text.error_only(c).alias("error_only"), n_markers.alias("n_markers"),
        joined(qa.structure_issues(c, up)).alias("issues"), F.md5(text.section(c, "INVESTORS")).alias("section_md5"), F.md5(text.sanitize_text(c)).alias("cleaned_md5"),
    )


@query
def block_actions(spark, sf_dir):
    return B.block_actions(T.blocks(spark, sf_dir)).select("page_id", "pos", "action", F.md5("cleaned").alias("cleaned_md5"))


@query
def block_action_counts(spark, sf_dir):
    b = B.block_actions(T.blocks(spark, sf_dir))
    return b.groupBy("page_id").agg(F.count_if(F.col("action") == "clean").alias("n_cleaned"), F.count_if(F.col("action") == "remove").alias("n_removed"))


@query
def page_text(spark, sf_dir):
    return B.page_text(T.blocks(spark, sf_dir)).select("page_id", F.md5("content").alias("content_md5"))


@query
def cleaner_text(spark, sf_dir):
    return B.cleaner_text(T.blocks(spark, sf_dir)).select("page_id", F.md5("content").alias("content_md5"))


@query
def investor_clean(spark, sf_dir):
    return T.investors(spark, sf_dir).select("id", joined(entities.clean_investors(F.col("investors"))).alias("names"))


@query
def investor_clean_spec(spark, sf_dir):
    return T.investors(spark, sf_dir).select("id", joined(entities.clean_investors(F.col("investors"), "spec")).alias("names"))


@query
def corrupt_investor_lists(spark, sf_dir):
    i = T.investors(spark, sf_dir).select("id", F.size("investors").cast("long").alias("n_raw"), F.size(entities.clean_investors(F.col("investors"))).cast("long").alias("n_clean"))
    return i.where("n_raw <> n_clean")


@query
def canonical_blocks(spark, sf_dir):
    d = T.deals(spark, sf_dir)
    names = F.expr("CASE id % 3 WHEN 0 THEN cast(array() AS array<string>) WHEN 1 THEN array(concat('Fund ', id)) ELSE array('A', concat('B', id)) END")
    links = F.expr("CASE id % 2 WHEN 0 THEN cast(array() AS array<string>) ELSE array(concat('http://s/', id), 'http://t') END")
    return d.select("id", F.posexplode(B.canonical_blocks(F.col("company"), F.col("amount"), F.col("round_type"), names, links)).alias("pos", "b")).select("id", F.col("pos").cast("long").alias("pos"), "b.type", "b.text", "b.url")


@query
def replace_markers(spark, sf_dir):
    new = F.concat(F.lit("new $1 \\ "), F.col("company"))
    return T.pages(spark, sf_dir).select("page_id", F.md5(text.replace_between(F.col("content"), *qa.HIRING, new)).alias("content_md5"))


@query
def wrap_markers(spark, sf_dir):
    return T.deals(spark, sf_dir).select("id", text.wrap(F.col("company"), "HIRING INTELLIGENCE", *qa.HIRING).alias("wrapped"))


@query
def mcp_section_clean(spark, sf_dir):
    """Sections with a lookahead at their end: held against plain Python in the tests."""
    c = F.concat(F.lit("## INVESTOR WARM INTRO MAP\n- x "), F.col("content"), F.lit("\n\n## NEXT\nz\n"))
    return T.pages(spark, sf_dir).select("page_id", F.md5(text.clean_map_sections(c)).alias("content_md5"))


@query
def qa_note_append(spark, sf_dir):
    d = T.deals(spark, sf_dir)
    return d.select("id", text.append_note(F.expr("CASE WHEN id % 2 = 0 THEN '' ELSE run_id END"), F.col("company"), F.date_format("seen_at", "yyyy-MM-dd")).alias("issues"))


@query
def failure_runs(spark, sf_dir):
    return R.failure_runs(T.calls(spark, sf_dir))


@query
def breaker_states(spark, sf_dir):
    return R.breaker_summary(R.breaker_log(T.calls(spark, sf_dir), THRESHOLD, RESET))


@query
def backoff_schedule(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    waits = R.backoff((F.col("event_id") % 4).cast("int"), F.lit(2.0) + (F.col("event_id") % 3))
    return e.select("event_id", F.posexplode(waits).alias("attempt", "wait")).select("event_id", F.col("attempt").cast("long").alias("attempt"), "wait")


@query
def retry_class(spark, sf_dir):
    names = [*R.RETRYABLE, "HTTPError", "ValueError", "KeyError"]
    error = F.element_at(F.array(*map(F.lit, names)), (F.col("event_id") % len(names) + 1).cast("int"))
    e = T.table(spark, sf_dir, "events").select("event_id", error.alias("error"))
    return e.select("event_id", "error", R.retry_class(F.col("error")).alias("action"))


@query
def fallback_text(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    answer = F.when(F.col("event_type") != "error", F.col("props"))
    return e.select("event_id", F.coalesce(answer, F.lit("Unavailable.")).alias("answer"), F.size(F.coalesce(F.when(answer.isNotNull(), F.array(answer)), F.array().cast("array<string>"))).cast("long").alias("n_results"))


@query
def llm_json_path(spark, sf_dir):
    c = T.table(spark, sf_dir, "conversations")
    body = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content"), "role").alias("message"))).alias("choices")))
    return c.select("conv_id", "turn", F.md5(F.get_json_object(body, "$.choices[0].message.content")).alias("content_md5"))


@query
def pattern_gap(spark, sf_dir):
    """The distinct lines of blocks by whether they fail the page check and whether cleaning changes them."""
    p = T.blocks(spark, sf_dir).select(F.explode(F.split("text", "\n", -1)).alias("phrase")).distinct()
    told = p.select("phrase", (F.size(text.error_hits(F.col("phrase"))) > 0).alias("fails"), (text.sanitize_text(F.col("phrase")) != F.col("phrase")).alias("cleaned"))
    return told.groupBy("fails", "cleaned").agg(F.count("*").alias("n_lines"), F.min("phrase").alias("first_line"))


@query
def raw_properties(spark, sf_dir):
    """Events' properties through VARIANT, some of them malformed, null, missing or of another type."""
    raw = F.expr("""CASE event_id % 7 WHEN 1 THEN '{"k": null}' WHEN 2 THEN replace(replace(props, ': ', ': "'), '}', '"}') WHEN 3 THEN concat('{', props) WHEN 4 THEN '{}' WHEN 5 THEN NULL ELSE props END""")
    e = T.table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).withColumn("v", properties.parsed(F.col("raw")))
    return e.select("event_id", properties.typed(F.col("raw"), F.col("v"), "$.k", "bigint").alias("k")).select("event_id", "k.*")


@query
def event_rollup(spark, sf_dir):
    """Calls and failures by service and hour: what the stream of error counts gives at its end."""
    e = T.table(spark, sf_dir, "events")
    return e.groupBy((F.col("user_id") % 4).alias("service"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count_if(F.col("event_type") == "error").alias("n_failed"), F.count("*").alias("n_calls"))


@query
def amount_match_links(spark, sf_dir):
    """The pairs of amount_match_pairs as classes of equal amounts and a number of links per deal."""
    return dedup.tolerance_links(T.deals(spark, sf_dir), "slug")


@query
def page_by_id(spark, sf_dir):
    """A point read: one page's properties."""
    return T.page_rows(spark, sf_dir).where("page_id = 7").select("page_id", "entry", "type", "source_skill", "report_key", "run_id")


@query
def outreach_page_exists(spark, sf_dir):
    """Outreach pages whose title contains a deal's company."""
    return dedup.containing(T.deals(spark, sf_dir), T.page_rows(spark, sf_dir), "entry", "OUTREACH TARGET")


@query
def zero_amount_lookup(spark, sf_dir):
    """Canonical pages whose company contains that of a deal of unknown amount."""
    return dedup.containing(T.deals(spark, sf_dir).where("amount = 0"), T.page_rows(spark, sf_dir), "company", "FUNDRAISING INTEL")


def _audited_before(spark, sf_dir):
    old = {"qa_status": F.expr("CASE page_id % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' END"), "qa_issues": F.expr("CASE page_id % 3 WHEN 1 THEN 'old' ELSE '' END"), "last_audited_at": F.lit("2026-01-01").cast("timestamp")}
    return T.pages(spark, sf_dir).withColumns(old)


@query
def qa_write_back(spark, sf_dir):
    """Pages after their check was written back; archived ones keep what they had."""
    out = qa.audited(_audited_before(spark, sf_dir), F.lit(NOW).cast("timestamp"))
    return out.select("page_id", "qa_status", "qa_issues", F.date_format("last_audited_at", "yyyy-MM-dd HH:mm:ss").alias("audited_at"))


@query
def legacy_prefix_counts(spark, sf_dir):
    """Per deal, the pages whose key starts with its legacy prefix, however they go on: the company V3's prefix starts all v3 keys."""
    d = T.deals(spark, sf_dir).select("id", keys.legacy_prefix(F.expr("CASE WHEN id % 100 = 7 THEN 'V3' ELSE company END")).alias("prefix"))
    found = names.starting_with(d, T.page_rows(spark, sf_dir).select(F.col("report_key").alias("key")))
    return d.join(found, "prefix").select("id", "n_keys")


@query
def near_slugs(spark, sf_dir):
    """Companies whose slugs differ from others' by one character."""
    return names.near_names(T.deals(spark, sf_dir), "slug").withColumnRenamed("name", "slug")


@query
def paged_calls(spark, sf_dir):
    """Failed calls from an id on by service, through the paged source: id and type are pushed down to it, the service isn't."""
    e = paged.read_paged(spark, "recsieve.sources.paged:ParquetPages", "event_id long, ts timestamp_ntz, user_id long, event_type string", 500, path=f"{sf_dir}/events.parquet", columns=["ts", "event_id", "event_type"])
    late = e.where("event_type = 'error' and event_id >= 500 and user_id % 4 < 3")
    return late.groupBy((F.col("user_id") % 4).alias("service")).agg(F.count("*").alias("n_failed"), F.max("event_id").alias("last_id"))


@query
def upserted_pages(spark, sf_dir):
    """A stored table of canonical pages by key after two upserts: pages found later create or update; of one key, the latest counts."""
    t = StoredTable(spark, f"{checkpoint_dir(spark)}/pages-{uuid.uuid4().hex}", ("report_key",), 16)
    d = T.deals(spark, sf_dir).select("report_key", F.col("id").alias("page_id"), "amount", "seen_at")
    early = F.col("seen_at") < F.lit("1995-06-01").cast("timestamp_ntz")
    t.upsert(d.where(early), F.struct("seen_at", "page_id"), "early")
    t.upsert(d.where(~early).select("report_key", "page_id", "seen_at", F.lit("PASS").alias("qa_status")), F.struct("seen_at", "page_id"), "late")
    t.upsert(d.where(early).withColumn("amount", F.lit(-1).cast("long")), batch="late")  # a batch given again changes nothing
    return t.read().select("report_key", "page_id", "amount", "qa_status")


@query
def qa_stats_json(spark, sf_dir):
    return qa.status_json(qa.status_histogram(qa.validate_pages(T.pages(spark, sf_dir))))


@query
def moved_dedup_notes(spark, sf_dir):
    note = F.expr("CASE page_id % 9 WHEN 1 THEN '\\nArchived duplicate: x\\nend' WHEN 2 THEN '\\n- Dedup cleanup' WHEN 3 THEN '\\narchived duplicate: y' ELSE '' END")
    p = T.pages(spark, sf_dir).withColumns({"content": F.concat("content", note), "qa_issues": F.expr("CASE WHEN page_id % 2 = 0 THEN 'old' END")})
    return B.moved_notes(p, F.date_format("date", "yyyy-MM-dd")).select("page_id", F.md5("content").alias("content_md5"), "qa_issues", "n_moved")


@query
def applied_blocks(spark, sf_dir):
    """Blocks as they are after cleaning: removed ones gone, cleaned ones with their new text."""
    return B.apply_actions(B.block_actions(T.blocks(spark, sf_dir))).select("page_id", "pos", "type", F.md5("text").alias("text_md5"))


@query
def tree_page_text(spark, sf_dir):
    return trees.tree_text(T.block_tree(spark, sf_dir)).select("page_id", F.md5("content").alias("content_md5"))


@query
def tree_page_text_first_page(spark, sf_dir):
    """With one child read of each nested block, as a reader does that doesn't ask for further pages."""
    return trees.tree_text(T.block_tree(spark, sf_dir), 1).select("page_id", F.md5("content").alias("content_md5"))


@query
def deep_tree_text(spark, sf_dir):
    """Trees whose depth grows with the events: a spine with leaves at each place."""
    return trees.tree_text(T.deep_blocks(spark, sf_dir)).select("page_id", F.md5("content").alias("content_md5"))


@query
def unread_tree_blocks(spark, sf_dir):
    """Blocks of those trees that no root leads to after some were deleted and one put below its own child."""
    b = T.deep_blocks(spark, sf_dir).where("block_id % 400 <> 201").withColumn("parent_id", F.expr("CASE WHEN block_id div 4 = 15 THEN block_id + 20 ELSE parent_id END"))
    return trees.unread_blocks(b).groupBy("page_id", "reason").agg(F.count("*").alias("n_blocks"), F.min("block_id").alias("first_block"))


@query
def text_properties(spark, sf_dir):
    c = T.table(spark, sf_dir, "conversations")
    kind = F.expr("CASE conv_id % 5 WHEN 0 THEN 'rich_text' WHEN 1 THEN 'title' WHEN 2 THEN 'select' WHEN 3 THEN 'number' END")
    spans = F.array(F.struct(F.concat(F.lit(" "), "role").alias("plain_text")), F.struct(F.when(F.col("turn") % 2 == 0, F.lit(": ")).alias("plain_text")), F.struct(F.col("text").alias("plain_text")))
    prop = F.struct(kind.alias("type"), spans.alias("spans"), F.when(F.col("turn") % 3 > 0, F.col("role")).alias("name"))
    return c.select("conv_id", "turn", prop.alias("p")).select("conv_id", "turn", F.md5(B.text_property(F.col("p"))).alias("value_md5"))


@query
def page_properties_poc(spark, sf_dir):
    users = F.expr("CASE id % 3 WHEN 0 THEN cast(array() AS array<string>) WHEN 1 THEN array(concat('user-', id)) ELSE array('a', concat('b', id)) END")
    d = T.deals(spark, sf_dir)
    out = d.select("id", *B.page_properties(F.col("company"), F.col("amount"), F.col("round_type"), F.col("run_id"), F.lit(NOW).cast("timestamp"), users))
    return out.select("id", "entry", "qa_status", joined(F.col("poc")).alias("poc"))


@query
def preset_breaker_states(spark, sf_dir):
    """Services with their own thresholds; one that has none set uses the usual ones."""
    return R.breaker_summary(R.preset_breaker_log(T.named_calls(spark, sf_dir)))
