"""Queries read their whole tables, not the rows that the smallest tables happen to have."""

import math
import os

import pytest
from oracle import check

from recsieve.plans import catalogue
from recsieve.sources import tables as T

SF, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ERROR = "a\nTraceback (most recent call last): requests.exceptions.X"


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """The smallest tables with 250 documents: number 210 is null, 220 has an error, 230 is very long."""
    at = tmp_path_factory.mktemp("wide")
    for name in os.listdir(SF):
        if name != "documents.parquet":
            os.symlink(f"{SF}/{name}", at / name)
    odd = {210: None, 220: ERROR, 230: "long " * 200_000 + "x"}
    spark.createDataFrame([(i, odd.get(i, f"text of {i}")) for i in range(250)], "doc_id long, text string").write.parquet(str(at / "documents.parquet"))
    return str(at)


def test_pages_read_every_document(spark, wide):
    got = {r.page_id: r.content for r in T.pages(spark, wide).select("page_id", "content").collect()}
    deals = {r.id for r in T.deals(spark, wide).select("id").collect()}
    assert got.keys() == deals
    for i, content in got.items():
        d = i % 250
        if i % 7 and d not in (210, 220, 230):
            assert content.split("\n")[0] == f"text of {d}"
    assert all(got[i] is not None for i in got if i % 250 == 210) and any(i % 250 == 210 for i in got)
    assert any(got[i].startswith(ERROR) for i in got if i % 250 == 220) and any(len(x) > 1_000_000 for x in got.values())


def test_raw_scans_read_every_text(spark, wide):
    got = {(r.source, r.id): r for r in catalogue.QUERIES["raw_scans"](spark, wide).collect()}
    want = {(t, r[0]) for t, i in (("documents", "doc_id"), ("pages", "page_id"), ("benchmark", "item_id")) for r in spark.read.parquet(f"{wide}/{t}.parquet").select(i).collect()}
    assert got.keys() == want
    assert [k for k, r in got.items() if r.n_hits and k[0] == "documents"] == [("documents", 220)]
    assert got["documents", 220].first_hits == "Traceback (most recent call last)|requests.exceptions." and not got["documents", 210].n_hits
    assert got["documents", 230].n_markers == 0


@pytest.mark.parametrize("name", ["qa_issues", "sanitize_text", "error_hits"])
def test_pages_bind_by_the_count_of_documents(spark, name):
    """Where there are more than 200 documents."""
    assert check(spark, MORE, name, catalogue.QUERIES[name], catalogue.SQL[name]) == 15000


def test_every_deal_is_looked_up(spark):
    """Against plain Python: deals of amount 0, whose keys are the common ones, as well."""
    deals = T.deals(spark, SF).select("id", "slug", "report_key", "amount").collect()
    pages = T.pages(spark, SF).select("page_id", "report_key").collect()
    exact, legacy = {}, {}
    for p in pages:
        parts = p.report_key.split(":")
        if len(parts) == 4 and parts[:2] == ["fundraising-intel", "v3"]:
            exact.setdefault(p.report_key, []).append(p.page_id)
        elif len(parts) == 3 and parts[0] == "fundraising-intel":
            legacy.setdefault(parts[1], []).append(p.page_id)
    want = [(d.id, i, "v3") for d in deals for i in exact.get(d.report_key, ())] + [(d.id, i, "legacy") for d in deals for i in legacy.get(d.slug, ())]
    got = [tuple(r) for r in catalogue.QUERIES["legacy_or_v3_lookup"](spark, SF).select("id", "page_id", "scheme").collect()]
    assert sorted(got) == sorted(want)
    unknown = {d.id for d in deals if d.amount == 0 and d.id % 5 != 1}
    assert unknown and unknown & {i for i, _, _ in got}


def test_band_pairs_of_all_customers(spark):
    """Against plain Python: negative balances match no price."""
    left = [(r[0], math.floor(r[1])) for r in spark.read.parquet(f"{MORE}/customer.parquet").select("c_custkey", "c_acctbal").collect()]
    right = [(r[0], math.floor(r[1])) for r in spark.read.parquet(f"{MORE}/part.parquet").select("p_partkey", "p_retailprice").collect()]
    want = {(a, b) for a, m in left for b, n in right if (m == n if 0 in (m, n) else abs(m - n) / max(m, n) <= 0.05)}
    got = [tuple(r) for r in catalogue.QUERIES["amount_band_pairs_customers"](spark, MORE).select("a", "b").collect()]
    assert any(m < 0 for _, m in left) and len(got) == len(want) and set(got) == want


TEXTLESS = [
    "parsed_keys", "key_schemes", "canonical_pick", "legacy_or_v3_lookup", "zero_amount_guard", "canonical_missing", "canonical_present", "outreach_pairs", "archived_skip", "recent_pages", "page_by_id", "outreach_page_exists",
    "zero_amount_lookup",
]


@pytest.mark.parametrize("name", TEXTLESS)
def test_pages_without_their_text_read_no_documents(spark, sf, name):
    plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in plan and "n_docs" not in plan and "doc_id" not in plan
