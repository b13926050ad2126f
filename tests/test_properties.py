from pyspark.sql import functions as F

from recsieve.functions.properties import parsed, typed


def test_states_and_values(spark):
    rows = [None, "", "{", '{{"a": 1}', "{}", '{"a": null}', '{"a": "x"}', '{"a": 7}', '{"a": 1.5}', '{"a": true}', '{"a": {"b": 7}}', '{"a": [1]}', "3"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, raw string").withColumn("v", parsed(F.col("raw")))
    show = lambda path, kind: [(r.k.state, r.k.value) for r in sorted(df.select("i", typed(F.col("raw"), F.col("v"), path, kind).alias("k")).collect())]
    no = [("none", None), ("malformed", None), ("malformed", None), ("malformed", None), ("missing", None), ("null", None)]
    other = ("type", None)
    assert show("$.a", "bigint") == [*no, other, ("ok", 7), other, other, other, other, ("missing", None)]
    assert show("$.a", "string") == [*no, ("ok", "x"), other, other, other, other, other, ("missing", None)]
    assert show("$.a", "double")[7:9] == [("ok", 7.0), ("ok", 1.5)] and show("$.a", "boolean")[9] == ("ok", True)
    assert show("$.a.b", "bigint")[10] == ("ok", 7) and show("$.a[0]", "bigint")[11] == ("ok", 1)
