from collections import Counter

import corpus_pipeline
from test_op2 import brute as near_groups
from test_op6_op10 import contaminated, found
from test_op7_op8 import plain_verdicts


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "redact_secrets", "mix_sources"]

    kept = stage["quality_rules"](spark, docs, sf)
    every = [(r.doc_id, r.text) for r in docs.collect()]
    good = {d for (d, _), (_, ok) in zip(every, plain_verdicts([t for _, t in every])) if ok}
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert {d for d, _ in rows} == good and len(rows) == len(good) < docs.count()

    one = stage["near_dedup"](spark, kept, sf)
    want = {d for d, _, _, k in near_groups(rows) if k}
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert {d for d, _ in rows} == want and len(rows) == len(want)

    clean = stage["decontaminate"](spark, one, sf)
    want = {int(d) for d, _, hit, _ in contaminated(rows, bench) if not hit}
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert {d for d, _ in rows} == want

    safe = stage["redact_secrets"](spark, clean, sf)
    before = dict(rows)
    after = {r.doc_id: r for r in safe.collect()}
    assert set(after) == set(before)
    assert any(found(t) for t in before.values()) and not any(found(r.text) for r in after.values())
    assert all(r.n_chars == len(r.text) for d, r in after.items() if r.text != before[d])
    assert all(r.text == before[d] for d, r in after.items() if not found(before[d]) and "[SECRET]" not in r.text)
    assert kept.columns == one.columns == clean.columns == safe.columns == docs.columns

    mixed = stage["mix_sources"](spark, safe, sf).collect()
    assert {r.doc_id for r in mixed} == set(after)
    assert max(Counter(r.doc_id for r in mixed).values()) == 2
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(str, whole)) == sorted(map(str, mixed))


def test_empty(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_edges(spark):
    """Nulls in any column, repeated rows, a very long text, columns with names that the operators use."""
    sf = "/root/testdata/sf0.001"
    prose = " ".join(f"{w}{i}" for i in range(40) for w in ("the", "river", "of", "stone"))
    rows = [(1, prose, "en", "web", 1), (1, prose, "en", "web", 1), (2, prose + " end", None, None, None), (None, "other " + " ".join(f"word{i} and" for i in range(90)), "en", "web", None), (3, None, None, "web", None), (4, "", "en", None, 0), (5, " ".join(f"long{i % 70_000} then" for i in range(150_000)), "en", "books", 9), (6, prose.replace("stone", "sand") + " password: abcdefgh12345678 " + prose[::-1], "en", "web", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as _k1", "'r' as `row`", "2 as found", "3 as id", "4 as kept", "cast(null as string) as n_words", "5 as `a.b`")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["quality_rules"](spark, docs, sf)
    assert kept.columns == docs.columns
    assert not {3, 4} & {r.doc_id for r in kept.collect()}
    one = stage["near_dedup"](spark, docs, sf)
    assert one.columns == docs.columns
    assert sorted((r.doc_id for r in one.collect()), key=str) == [1, 3, 4, 5, 6, None]
    clean = stage["decontaminate"](spark, docs, sf)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    safe = stage["redact_secrets"](spark, docs, sf)
    assert safe.columns == docs.columns and safe.count() == len(rows)
    changed = [r for r in safe.collect() if r.text and "[SECRET]" in r.text]
    assert [(r.doc_id, r.n_chars) for r in changed] == [(6, len(changed[0].text))] and "abcdefgh12345678" not in changed[0].text
    mixed = stage["mix_sources"](spark, docs, sf).collect()
    assert {r.doc_id for r in mixed} == {r[0] for r in rows}
