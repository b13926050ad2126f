from pyspark.sql import functions as F

from recsieve.operators import qa
from recsieve.operators import resilience as R
from recsieve.sources import tables as T
from recsieve.sources.remote import Breaker, call_each, resilient_call
from recsieve.streaming import streams

SF = "/root/testdata/sf0.001"


def run(stream, tmp_path, name):
    query = streams.write_batches(stream, lambda df, _: df.write.mode("append").parquet(f"{tmp_path}/{name}"), f"{tmp_path}/{name}-state")
    query.awaitTermination()
    return f"{tmp_path}/{name}"


def source(spark, df, tmp_path, name, files=3):
    df.repartition(files).write.parquet(f"{tmp_path}/{name}-in")
    return spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}-in")


def test_breaker_stream_is_the_batch_fold(spark, tmp_path):
    calls = T.calls(spark, SF)
    got = spark.read.parquet(run(streams.breaker_stream(source(spark, calls, tmp_path, "c"), 2, 1800.0), tmp_path, "calls"))
    want = R.breaker_log(calls, 2, 1800.0).select("service", "t", "id", "allowed", "fails", "state")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_qa_stream_is_the_batch_check(spark, tmp_path):
    pages = T.pages(spark, SF)
    got = spark.read.parquet(run(streams.validated_stream(source(spark, pages, tmp_path, "p")), tmp_path, "pages"))
    show = lambda df: sorted(map(tuple, df.select("page_id", "qa_status", "qa_issues").collect()))
    assert show(got) == show(qa.validate_pages(pages))


def test_first_of_key_stream(spark, tmp_path):
    deals = T.deals(spark, SF).withColumn("seen_at", F.lit("2024-01-01").cast("timestamp"))
    got = spark.read.parquet(run(streams.first_of_key(source(spark, deals, tmp_path, "d")), tmp_path, "deals"))
    assert got.count() == got.select("report_key").distinct().count() == deals.select("report_key").distinct().count()


def test_error_counts_stream(spark, tmp_path):
    calls = T.table(spark, SF, "events").select((F.col("user_id") % 4).alias("service"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"))
    stream = streams.error_counts(source(spark, calls, tmp_path, "e", 1), late="60 days")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("error_counts").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/e-state").start()
    query.awaitTermination()
    got = spark.sql("SELECT sum(n_failed) f, sum(n_calls) n FROM error_counts").first()
    assert (got.f, got.n) == (calls.where("not ok").count(), calls.count())


def test_resilient_calls(spark):
    now, waits = [0.0], []
    b = Breaker(2, 100.0, clock=lambda: now[0])

    def fail(e):
        raise e

    call = lambda fn: resilient_call(fn, b, fallback="f", sleep=waits.append)
    assert call(lambda: fail(TimeoutError())) == "f" and waits == [2.0, 4.0] and b.state == "closed"
    assert call(lambda: fail(ValueError())) == "f" and len(waits) == 2 and b.state == "open"
    assert call(lambda: "never") == "f"
    now[0] = 100.0
    assert b.state == "half-open" and call(lambda: "ok") == "ok" and b.state == "closed"
    rows = spark.createDataFrame([("a",), ("b",)], "q string")

    def client(x):
        if x == "b":
            raise KeyError(x)
        return x * 2

    assert {(r.q, r.answer) for r in call_each(rows, "q", client, fallback="none").collect()} == {("a", "aa"), ("b", "none")}
