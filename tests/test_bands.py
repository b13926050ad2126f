from recsieve.operators.dedup import band_pairs


def test_band_pairs_match_amounts_once_for_all_their_rows(spark):
    """Against plain Python; rows join by equality of amounts, so buckets are met by distinct amounts alone."""
    a = [(i, x) for i, x in enumerate([None, -5, -100, 0, 0, 1, 95, 100, 105, 106, 1000, 1000, 1000, 10**15])]
    b = [(i, x) for i, x in enumerate([None, -5, 0, 1, 2, 95, 100, 100, 1050, 951, 950, 949, 10**15 - 1])]
    l, r = spark.createDataFrame(a, "a long, amount_a long"), spark.createDataFrame(b, "b long, amount_b long")  # noqa: E741
    pairs = band_pairs(l, r)
    near = lambda x, y: x == y if 0 in (x, y) else abs(x - y) / max(x, y) <= 0.05
    want = sorted((i, j) for i, x in a for j, y in b if None not in (x, y) and x >= 0 and y >= 0 and near(x, y))
    assert sorted(map(tuple, pairs.collect())) == want and len(want) > 12
    assert "SortMergeJoin [amount_b" in pairs._jdf.queryExecution().executedPlan().toString()
