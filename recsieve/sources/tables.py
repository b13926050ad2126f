"""The engine's inputs, bound to the star-schema tables: deals, pages, calls, investor lists, blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from recsieve.functions.amounts import parse_amount
from recsieve.functions.keys import report_key, slugify


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, company, slug, amount_str, amount, report_key, round_type, run_id, seen_at."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    raw = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("id"), F.replace("c_name", F.lit("#"), F.lit(" ")).alias("company"), F.col("o_orderpriority").alias("round_type"), F.col("o_orderdate").alias("seen_at"),
        F.expr("floor(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1D WHEN 1 THEN 100D WHEN 2 THEN 10000D ELSE 0.001D END)").cast("long").alias("n"),
        F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(F.concat(F.lit("run-"), F.col("o_orderkey").cast("string"))).alias("run_id"),
    )
    text = F.expr("""CASE WHEN id % 97 = 0 THEN NULL ELSE CASE id % 8 WHEN 0 THEN concat('$', n div 1000000, 'M')
        WHEN 1 THEN concat('$', n div 1000000, '.', lpad(cast(n % 1000000 div 10000 AS string), 2, '0'), 'M') WHEN 2 THEN concat(n div 1000, 'K')
        WHEN 3 THEN concat('$', n div 1000, ',', lpad(cast(n % 1000 AS string), 3, '0')) WHEN 4 THEN '' WHEN 5 THEN 'undisclosed'
        WHEN 6 THEN concat(' -$ ', n div 1000, 'k ') ELSE concat(n div 1000000, '.5b') END END""")
    rows = raw.withColumn("amount_str", text).withColumn("amount", parse_amount(F.col("amount_str")))
    return rows.select("id", "company", slugify(F.col("company")).alias("slug"), "amount_str", "amount", report_key(F.col("company"), F.col("amount")).alias("report_key"), "round_type", "run_id", "seen_at")


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, entry, type, source_skill, report_key, run_id, company, slug, date: a page per deal, without its text."""
    return deals(spark, sf_dir).select(
        F.col("id").alias("page_id"), F.expr("concat(CASE WHEN id % 23 = 0 THEN '[Archived] ' ELSE '' END, company)").alias("entry"),
        F.expr("CASE id div 7 % 3 WHEN 0 THEN 'FUNDRAISING INTEL' WHEN 1 THEN 'SIGNAL PACK' ELSE 'OUTREACH TARGET' END").alias("type"), F.expr("CASE WHEN id % 19 = 0 THEN '' ELSE 'funding-intel-brief' END").alias("source_skill"),
        F.expr("CASE WHEN id % 17 = 0 THEN '' WHEN id % 3 = 0 THEN concat('fundraising-intel:', slug, ':', date_format(seen_at, 'yyyy-MM-dd')) ELSE report_key END").alias("report_key"), "run_id", "company", "slug", F.col("seen_at").alias("date"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_rows() with content.

    The text is that of the document `page_id % n_docs`, whatever number of documents there is. A null text is empty, as is that of a
    deal whose document isn't there.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    n = table(spark, sf_dir, "documents").agg(F.nullif(F.count("*"), F.lit(0)).alias("n_docs"))
    own = page_rows(spark, sf_dir)
    rows = own.crossJoin(F.broadcast(n)).withColumn("of", F.expr("page_id % n_docs")).join(docs, F.col("of") == F.col("d"), "left").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("id", F.col("page_id"))
    content = F.expr("""concat(CASE WHEN id % 7 = 0 THEN '' ELSE text END,
        CASE id % 5 WHEN 1 THEN '\\n[[OUTREACH_INTEL_AUTO_START]]' WHEN 2 THEN '\\n[[OUTREACH_INTEL_AUTO_END]]' WHEN 3 THEN '\\n[[OUTREACH_INTEL_AUTO_START]]x[[OUTREACH_INTEL_AUTO_END]]'
            WHEN 4 THEN '\\n[[OUTREACH_INTEL_AUTO_START]]x[[OUTREACH_INTEL_AUTO_START]]y[[OUTREACH_INTEL_AUTO_END]]' ELSE '' END,
        CASE id % 6 WHEN 1 THEN '' WHEN 2 THEN '\\n[[HIRING_INTEL_AUTO_START]]' WHEN 3 THEN '\\n[[HIRING_INTEL_AUTO_END]]' WHEN 5 THEN '\\n[[HIRING_INTEL_AUTO_START]][[HIRING_INTEL_AUTO_START]][[HIRING_INTEL_AUTO_END]]'
            ELSE '\\n[[HIRING_INTEL_AUTO_START]]x[[HIRING_INTEL_AUTO_END]]' END,
        CASE id % 11 WHEN 0 THEN '\\n- mcp_unavailable mcp_unavailable' WHEN 1 THEN '\\nTIMEOUTERROR timeouterror' WHEN 2 THEN '\\n[Grok error: quota] tail'
            WHEN 3 THEN '\\nSearch error: HTTPSConnectionPool(host=''other'') x\\n\\n\\n\\nmore' WHEN 4 THEN '\\nHTTPSConnectionPool(host=a): Max retries exceeded' ELSE '' END,
        CASE id % 13 WHEN 0 THEN '\\nMarket Snapshot and signal' WHEN 1 THEN '\\nDeal Summary\\nSources' ELSE '' END,
        CASE id % 4 WHEN 0 THEN '\\n# INVESTORS\\n- a\\n- b' WHEN 1 THEN '\\n# INVESTORS\\n- a\\n' WHEN 2 THEN '\\n## Investors\\nnone' ELSE '' END)""")
    return rows.select(*own.columns, content.alias("content"))


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, id, content: every text of documents, pages and benchmark as it is; a null text is empty."""
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("source"), F.col(i).cast("long").alias("id"), F.coalesce(c, F.lit("")).alias("content")) for t, i, c in (("documents", "doc_id", "text"), ("pages", "page_id", "html"), ("benchmark", "item_id", "text"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def investors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, investors: the suppliers of an order by line, with fragments of persons and roles put in."""
    odd = F.expr("CASE (l_linenumber + l_orderkey) % 9 WHEN 0 THEN '(co-founder' WHEN 1 THEN concat(s_name, ')') WHEN 2 THEN 'Jane Roe (CEO/co-founder' WHEN 3 THEN concat(' ', upper(s_name), ' ') WHEN 4 THEN 'Partner' WHEN 5 THEN '' WHEN 6 THEN concat(s_name, ' (NY)') ELSE s_name END")
    lines, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    rows = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey).select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_suppkey", odd.alias("name"))
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "name")))
    return rows.groupBy("id").agg(F.transform(ordered, lambda x: x["name"]).alias("investors"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """service, t (seconds), id, ok. Times without a zone are taken as they stand, whatever the session's zone does to its clock."""
    e = table(spark, sf_dir, "events")
    plain = isinstance(e.schema["ts"].dataType, TimestampNTZType)
    t = F.expr("cast(cast(ts - timestamp_ntz'1970-01-01' AS interval second) AS decimal(18, 6))" if plain else "unix_micros(ts) / 1000000D")
    return e.select((F.col("user_id") % 4).alias("service"), t.cast("double").alias("t"), F.col("event_id").alias("id"), (F.col("event_type") != "error").alias("ok"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, pos, type, text: turns of conversations, errors put in."""
    text = F.expr("""CASE (conv_id + turn) % 9 WHEN 0 THEN 'mcp_unavailable' WHEN 1 THEN concat(text, ' [Grok error: q] b') WHEN 2 THEN concat('[Grok error: x] ', text, ' [y]')
        WHEN 3 THEN concat('Search error: HTTPSConnectionPool(host=''o'') ', text) WHEN 4 THEN concat('a\\nHTTPSConnectionPool(host=a): Max retries exceeded\\n', text) WHEN 5 THEN concat(' \\n', text, '\\n\\n\\n\\nz') WHEN 6 THEN NULL ELSE text END""")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page_id"), F.col("turn").alias("pos"), F.col("role").alias("type"), text.alias("text"))


def block_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, block_id, parent_id, pos, text: of four turns the first is a root, the second and fourth are its children, the third the second's."""
    parent = F.expr("CASE turn % 4 WHEN 0 THEN NULL WHEN 3 THEN turn - 3 ELSE turn - 1 END")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page_id"), F.col("turn").alias("block_id"), parent.alias("parent_id"), F.col("turn").alias("pos"), F.expr("CASE WHEN turn % 5 <> 4 THEN text END").alias("text"))


def deep_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, block_id, parent_id, pos, text: four pages of events, each a spine of every fifth block with the four after it as leaves."""
    k = "(event_id div 4)"
    parent = F.expr(f"CASE WHEN {k} = 0 THEN NULL WHEN {k} % 5 = 0 THEN event_id - 20 ELSE event_id - 4 * ({k} % 5) END")
    pos = F.expr(f"CASE WHEN {k} % 5 = 0 THEN 2 ELSE {k} % 5 END")
    return table(spark, sf_dir, "events").select((F.col("event_id") % 4).alias("page_id"), F.col("event_id").alias("block_id"), parent.alias("parent_id"), pos.alias("pos"), F.expr("CASE WHEN event_id % 7 <> 3 THEN concat(event_type, ' ', event_id) END").alias("text"))


SERVICES = ["duckduckgo", "grok", "icebreaker", "other"]


def named_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """calls() with services by name."""
    name = F.element_at(F.array(*map(F.lit, SERVICES)), F.col("service").cast("int") + 1)
    return calls(spark, sf_dir).withColumn("service", name)
