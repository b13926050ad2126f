import pytest
from oracle import check

from recsieve.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_against_sql(spark, name):
    # the smallest tables have no balance near a price
    n = check(spark, SF.replace("0.001", "0.01") if name == "amount_band_pairs" else SF, name, catalogue.QUERIES[name], catalogue.SQL[name])
    assert n > 0 or name in {"canonical_missing"}


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0
