"""The queries opN_<name> and their SQL: thin digests over the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.substring_dedup import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    from recsieve.llm.common import checkpoint_dir
    from recsieve.llm.warc import read_archives, write_archives

    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_tokens", "epoch", "weight", "mix_order")


def _secrets(found: DataFrame) -> DataFrame:
    from recsieve.llm.secrets import BASE, render

    kinds = [r.kind for r in BASE]
    n = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda x: x["kind"].isin(kinds))
    return found.select("doc_id", *map(n, kinds), F.sha2(render(base), 256).alias("base_sha256"), render(F.col("found")).alias("spans"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.secrets import scan

    return _secrets(scan(table(spark, sf_dir, "documents"))[0])


def secret_scan_with_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in two goes: a first scan with some rules leaves its ledger, and the second scans what that lacks."""
    from recsieve.llm.secrets import BASE, scan

    docs = table(spark, sf_dir, "documents")
    _, ledger = scan(docs, rules=BASE[:2])
    return _secrets(scan(docs, ledger=ledger)[0])


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.quality_model import held_out, score, train

    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.quality_rules import judge

    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.chat_format import pack_conversations, unpack
    from recsieve.llm.common import cut

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema))
    out = unpack(cut(pack_conversations(rows)))
    turns = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.decontaminate import contaminated_words

    out = contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from recsieve.llm.byte_bpe import decode, encode, read_vocabulary

    vocabulary = read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary), vocabulary)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _repeating(text, doc_id):
    """The words of a tenth of the texts with a period put in, as a text; others as they are."""
    from recsieve.llm.common import let

    h, i64 = F.crc32(doc_id.cast("string").cast("binary")), lambda x: F.floor(x).cast("long")
    g = i64(h / 10)

    def changed(w):
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + i64((n - a) / (3 + g % 8))
        of = lambda x: F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int")))
        return F.when(n > 0, F.array_join(let(F.struct(a.alias("a"), p.alias("p")), of), " ")).otherwise("")

    return F.when(h % 10 == 0, let(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), changed)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.periodic_runs import find_runs

    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", _repeating(F.col("text"), F.col("doc_id")).alias("text")))
    stronger = lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), stronger)
    lines = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n"))), "")
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsieve.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()} | {"secret_scan_with_ledger": secret_scan_with_ledger}


def _spans_sql(kind: str, pattern: str, group: int, least: int, place: int) -> str:
    """Per document the spans of one kind: matches and the pieces between them alternate."""
    return f"""
    SELECT doc_id, '{kind}' AS kind, {place} AS place, i AS k,
           list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0) AS s,
           length(matches[i]) AS size
    FROM (SELECT doc_id, gaps, matches, vals, unnest(range(1, len(matches) + 1)) AS i FROM (
        SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS matches, regexp_extract_all(t, '{pattern}', {group}) AS vals
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WHERE regexp_matches(t, '{pattern}')))
    WHERE length(vals[i]) >= {least}"""


def _op6_sql() -> str:
    from recsieve.llm.secrets import RULES

    parts = " UNION ALL ".join(_spans_sql(r.kind, r.plain.replace("'", "''"), r.group, r.least, i) for i, r in enumerate(RULES))
    base = "kind IN ('assign', 'access', 'hex')"
    count = lambda k: f"coalesce(count(*) FILTER (WHERE kind = '{k}'), 0)::BIGINT AS n_{k}"
    return f"""
    WITH spans AS ({parts}),
    named AS (SELECT doc_id, kind, place, s, kind || ':' || s::BIGINT || ':' || (s + size)::BIGINT AS name FROM spans),
    by_doc AS (SELECT doc_id, {", ".join(count(k) for k in ("assign", "access", "hex"))},
                      string_agg(name, ',' ORDER BY s, place) FILTER (WHERE {base}) AS b, string_agg(name, ',' ORDER BY s, place) AS a FROM named GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
    FROM documents d LEFT JOIN by_doc USING (doc_id)"""


_OP10_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM item)),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc CROSS JOIN (SELECT DISTINCT n FROM item) WHERE len(w) >= n)),
hits AS (SELECT g.doc_id, g.i, g.n, v.item_id FROM grams g JOIN windows v ON g.n = v.n AND g.x = v.x),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP1_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM doc WHERE len(w) >= 35)),
again AS (SELECT x FROM grams GROUP BY x HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM grams JOIN again USING (x)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP2_SQL = r"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0))),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
near AS MATERIALIZED (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 75 * (p.n + q.n - common)),
links AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept FROM doc d LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)
"""

_OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t)::BIGINT AS size, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS last FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', h[i])]), '') AS bits FROM d)
SELECT page_id, size AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(1, 6), lambda j: (bits[5 * i + j])::INT * (1 << (5 - j))))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM b
"""


def _op4_sql() -> str:
    from recsieve.llm.url_filter import MIN_SHARE, MODELS, ORDER, RULES, STRENGTH, SYMBOLS

    rules = sorted(RULES, key=lambda r: -len(r[1]))
    fits = lambda t: "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')".format(*t.split("/", 1))
    case = lambda at: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{r[at]}'" for r in rules) + " END"
    of = {"all": "", "first": " AND half = 0", "second": " AND half = 1"}
    names = [f"{m}_{k}" for m in MODELS for k in ("allow", "block")]
    each = lambda form: ", ".join(form.format(n=n) for n in names)
    counted = ", ".join(f"coalesce(sum(n) FILTER (WHERE said = '{k}'{of[m]}), 0) AS {m}_{k}" for m in MODELS for k in ("allow", "block"))
    levels = [f"l0 AS (SELECT g, {each('({n} + 1) / (of_{n} + ' + str(SYMBOLS) + ')::DOUBLE AS {n}')} FROM nodes WHERE length(g) = 1)"]
    levels += [f"l{k} AS (SELECT a.g, {each('(a.{n} + ' + str(STRENGTH) + '::DOUBLE * b.{n}) / (a.of_{n} + ' + str(STRENGTH) + '::DOUBLE) AS {n}')} FROM nodes a JOIN l{k - 1} b ON length(a.g) = {k + 1} AND a.g[2:] = b.g)" for k in range(1, ORDER + 1)]
    joins = " ".join(f"LEFT JOIN l{k} ON l{k}.g = g.g[{ORDER + 1 - k}:]" for k in range(ORDER + 1))
    ratio = lambda m: "coalesce(" + ", ".join(f"ln(l{k}.{m}_allow) - ln(l{k}.{m}_block)" for k in reversed(range(ORDER + 1))) + ")"

    return f"""
    WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
    hp AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
    j AS (SELECT *, {case(1)} AS rule, {case(0)} AS said, '{'^' * ORDER}' || regexp_replace(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9./_-]', '*', 'g') || '$' AS s FROM hp),
    u AS (SELECT host, path, said, s, CASE WHEN md5(host || path) < '8' THEN 0 ELSE 1 END AS half, count(*) AS n FROM j GROUP BY ALL),
    grams AS MATERIALIZED (SELECT host, path, said, half, n, substr(s, i, {ORDER + 1}) AS g FROM (SELECT *, unnest(range(1, length(s) - {ORDER - 1})) AS i FROM u)),
    long AS (SELECT g, {counted} FROM grams GROUP BY g),
    counts AS (SELECT g[-k:] AS g, {each('sum({n}) AS {n}')} FROM long, range(1, {ORDER + 2}) AS x(k) GROUP BY ALL),
    sums AS (SELECT *, {each('sum({n}) OVER (PARTITION BY g[:-2]) AS of_{n}')} FROM (SELECT * FROM counts WHERE length(g) > 1)
      UNION ALL SELECT *, {each('sum({n}) OVER () AS of_{n}')} FROM (SELECT * FROM counts WHERE length(g) = 1)),
    nodes AS MATERIALIZED (SELECT * FROM sums WHERE length(g) = 1 OR of_all_allow + of_all_block >= {MIN_SHARE}::DOUBLE * (SELECT sum(all_allow + all_block) FROM counts WHERE length(g) = 1)),
    {", ".join(levels)},
    scores AS (SELECT host, path, round(avg({ratio("all")}), 9) AS score, round(avg(CASE WHEN half = 0 THEN {ratio("second")} ELSE {ratio("first")} END), 9) AS unseen FROM grams g {joins} GROUP BY host, path),
    scored AS (SELECT page_id, host, path, rule, said, score, unseen FROM j JOIN scores USING (host, path)),
    c AS (SELECT avg(unseen) FILTER (WHERE said = 'allow') AS ma, stddev_pop(unseen) FILTER (WHERE said = 'allow') AS sa, avg(unseen) FILTER (WHERE said = 'block') AS mb, stddev_pop(unseen) FILTER (WHERE said = 'block') AS sb FROM scored)
    SELECT page_id, host, path, rule, coalesce(said, CASE WHEN ma IS NULL OR mb IS NULL OR score >= round(CASE WHEN sa + sb > 0 THEN (ma * sb + mb * sa) / (sa + sb) ELSE (ma + mb) / 2 END, 9) THEN 'allow' ELSE 'block' END) AS verdict FROM scored, c"""


_OP9_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + length(replace(regexp_replace(role, '(\\|###|</turn>)', '\\\1', 'g'), ':', '\:')) + length('### : </turn>' || chr(10)) AS size FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)) + y))) AS h FROM documents),
put AS (SELECT *, g % len(w) AS a, 1 + (len(w) - g % len(w)) // (3 + g % 8) AS p FROM (SELECT *, h // 10 AS g FROM d WHERE h % 10 = 0) WHERE len(w) > 0),
e AS MATERIALIZED (SELECT doc_id, list_transform(range(0, len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) AS w FROM put
  UNION ALL SELECT doc_id, w FROM d WHERE h % 10 <> 0 OR len(w) = 0),
grams AS MATERIALIZED (SELECT doc_id, i, n, array_to_string(w[i + 1:i + 5], ' ') AS x FROM (SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w) - 4)) AS i FROM e WHERE len(w) > 4)),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
islands AS (SELECT doc_id, q, min(i) AS s, count(*) + 4 + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs) GROUP BY doc_id, q, k),
runs AS MATERIALIZED (SELECT doc_id, s, l, min(q) AS q FROM islands WHERE l >= greatest(6, 4 * q) GROUP BY doc_id, s, l),
by_doc AS (SELECT doc_id, count(*) AS n_runs, string_agg(s::BIGINT || ',' || l::BIGINT || ',' || q::BIGINT || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l / q DESC, s, q) AS place FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM e) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT e.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period, (1000 * l // q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM e LEFT JOIN by_doc USING (doc_id) LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP13_SQL = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
w AS MATERIALIZED (SELECT lang, w FROM (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece) WHERE len(w) > 0),
total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) AS x(k) WHERE len(w) >= k)) GROUP BY ALL HAVING count(*) >= 100),
cand AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1),
inner_ AS (SELECT lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(a) AS most FROM (SELECT lang, p, a, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, 5) AS x(m) WHERE m < k) GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN inner_ USING (lang, phrase) WHERE coalesce(100 * most < 100 * a, true)),
cuts AS (SELECT lang, k, phrase, a, c, array_to_string(p[1:c], ' ') AS x, array_to_string(p[c + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS c FROM kept)),
scores AS (SELECT cuts.*, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score FROM cuts JOIN f l ON cuts.lang = l.lang AND x = l.phrase JOIN f r ON cuts.lang = r.lang AND y = r.phrase JOIN total ON cuts.lang = total.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op1_substring_dedup": _OP1_SQL, "op2_near_dedup": _OP2_SQL, "op3_warc": _OP3_SQL, "op4_url_filter": _op4_sql(), "op6_secret_scan": _op6_sql(), "op9_chat_format": _OP9_SQL, "op10_decontaminate": _OP10_SQL,
    "op12_periodic_runs": _OP12_SQL, "op13_collocations": _OP13_SQL,
}


SQL["secret_scan_with_ledger"] = SQL["op6_secret_scan"]


def oracle_sql() -> dict[str, str]:
    return SQL
