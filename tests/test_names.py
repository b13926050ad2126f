import random

import pytest

from recsieve.operators.names import near_names, starting_with


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_starting_with(spark):
    rng = random.Random(2)
    alphabet = ["a", "b", "é", "\U0010ffff", "\x7f", "\0"]
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(rng.randrange(n)))
    keys = [word(6) for _ in range(400)] + [None, "", "a", "a"] + ["hot"] * 500
    prefixes = [word(4) for _ in range(150)] + [None, "", "ho", "hot", "hott", "zz", "a"]
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        p, k = spark.createDataFrame([(x,) for x in prefixes], "prefix string"), spark.createDataFrame([(x,) for x in keys], "key string")
        got = {r.prefix: r.n_keys for r in starting_with(p, k).collect()}
        assert got == {x: sum(y is not None and y.startswith(x) for y in keys) for x in prefixes if x is not None}
        assert starting_with(p.where("false"), k).count() == 0 and {r.n_keys for r in starting_with(p, k.where("false")).collect()} == {0}
    spark.conf.set("spark.sql.shuffle.partitions", 8)


@pytest.mark.parametrize("most", [1, 2])
def test_near_names(spark, most):
    rng = random.Random(most)
    names = ["".join(rng.choice("abé") for _ in range(rng.randrange(7))) for _ in range(120)] + [None, "", "alone-in-the-world", "acme-inc", "acme-inc", "acme-in", "amce-inc"]
    got = {r.name: (r.n_rows, r.n_near, r.n_near_rows) for r in near_names(spark.createDataFrame([(x,) for x in names], "s string"), "s", most).collect()}
    known = [x for x in names if x is not None]
    assert got == {x: (known.count(x), len({y for y in known if y != x and distance(x, y) <= most}), sum(y != x and distance(x, y) <= most for y in known)) for x in known}


def test_near_names_broadcasts_no_names(spark):
    """Tables that look small to Spark, but aren't once characters are taken out: only lengths are broadcast, and no pairs are made at a distance of 1."""
    df = spark.range(50_000).selectExpr("concat('customer-', lpad(id % 1000, 9, '0')) as s")
    plan = near_names(df, "s")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "levenshtein" not in text and text.count("BroadcastHashJoin") == 1 and "BroadcastHashJoin [length(" in text
    assert {(r.n_rows, r.n_near, r.n_near_rows) for r in plan.collect()} == {(50, 27, 1350)}
    assert "BroadcastHashJoin" not in near_names(df, "s", 2)._jdf.queryExecution().executedPlan().toString()
