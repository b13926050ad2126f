import random

import duckdb
import pytest

from recsieve.operators.resilience import SliceMap, breaker_log, preset_breaker_log
from recsieve.plans import catalogue


def machine(calls, most, wait, state=(0, 0.0, False)):
    out = []
    for t, i, ok in calls:
        fails, last, is_open = state
        allowed = not is_open or t - last >= wait
        if allowed:
            state = (0, 0.0, False) if ok else (fails + 1, t, fails + 1 >= most)
        out.append((t, i, allowed, state[0], "open" if state[2] else "closed"))
    return out, state


def busy(rng, n, rate, failing):
    t, out = rng.random() * 50, []
    for i in range(n):
        t += rng.choice([0.0, rng.expovariate(rate), rng.expovariate(rate)])
        out.append((round(t, 3), i, rng.random() >= failing))
    return out


@pytest.mark.parametrize("most, wait", [(1, 5.0), (2, 30.0), (3, 0.0), (4, 3.0)])
def test_a_slice_maps_every_state(most, wait):
    """From any state at a slice's start, its map leads to where the calls do, one by one."""
    rng = random.Random(most)
    for n in (1, 2, 7, 60):
        for failing in (0.1, 0.5, 0.9, 1.0):
            calls = busy(rng, n, rng.choice([0.2, 1, 5]), failing)
            m = SliceMap(most, wait)
            for t, _, ok in calls:
                m.add(t, ok)
            rows = sorted(m.rows())
            states = [(f, 0.0, False) for f in range(most)] + [(rng.randrange(most, most + 4), calls[0][0] - rng.choice([0, 0.5, 3, 10, 29.9, 31]), True) for _ in range(12)]
            for state in states:
                end = next(((f + (state[0] if own else 0), last, o) for kind, start, f, last, o, own in rows if bool(kind) == state[2] and (start - state[1] >= wait if state[2] else start == state[0])), state)
                fails, last, is_open = machine(calls, most, wait, state)[1]
                assert end == (fails, last if is_open else 0.0, is_open), (calls, state)  # a closed breaker's last failure doesn't matter


@pytest.mark.parametrize("slice_s", [1.0, 20.0, 10_000.0])
def test_one_unbroken_session_in_many_slices(spark, slice_s):
    """A service that is never quiet, one with gaps, one without a name: slices of any length give what one reader gives."""
    rng = random.Random(7)
    streams = {"busy": busy(rng, 1500, 2, 0.45), "gaps": [(t * 40, i, ok) for t, i, ok in busy(rng, 200, 1, 0.6)], None: busy(rng, 60, 0.1, 0.7)}
    rows = [(s, t, i, ok) for s, calls in streams.items() for t, i, ok in calls]
    df = spark.createDataFrame(rows, "service string, t double, id long, ok boolean").repartition(5)
    got = sorted((tuple(r) for r in breaker_log(df, 3, 12.0, slice_s).collect()), key=lambda r: (str(r[0]), r[1], r[2]))
    want = [(s, *x) for s in sorted(streams, key=str) for x in machine(sorted(streams[s]), 3, 12.0)[0]]
    assert got == want
    assert len({x[4:] for x in want}) > 4 and any(not x[3] for x in want)
    assert breaker_log(df.where("false"), 3, 12.0).count() == 0


def test_no_task_has_more_than_a_slice(spark):
    """100,000 calls of one service, never quiet: each task's share is a slice's."""
    df = spark.range(100_000).selectExpr("1 as service", "id / 10D as t", "id", "id % 3 = 0 as ok")
    plan = breaker_log(df, 2, 1800.0, 600.0)
    assert plan.count() == 100_000
    text = plan._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in text.splitlines() if "REPARTITION_BY_COL" in line]
    assert sum("slice#" in line for line in dealt) >= 2 and "Window" not in text


def test_no_slice_is_split_where_joins_change_at_run_time(spark):
    """Calls too large to be broadcast, whose starts turn out small at run time: joins then read shuffles locally, in parts of a slice."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "20k"}
    mixed = sorted(((f"s{i % 2}", i / 10, i, i % 7 < 4) for i in range(6000)), key=lambda r: r[2] * 7919 % 6000)
    df = spark.createDataFrame(mixed, "service string, t double, id long, ok boolean").repartition(6)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        log = breaker_log(df, 2, 12.0, 50.0)
        dealt = [line for line in log._jdf.queryExecution().executedPlan().toString().splitlines() if "REPARTITION_BY_COL" in line]  # which no rule splits
        got = {(r.service, r.id): r[1:] for r in log.collect()}
    finally:
        for k in settings:
            spark.conf.unset(k)
    want = {(s, x[1]): x for s in ("s0", "s1") for x in machine(sorted(r[1:] for r in mixed if r[0] == s), 2, 12.0)[0]}
    assert got == want
    assert sum("slice#" in line for line in dealt) == 2


def test_services_keep_their_type_and_calls_without_a_time_are_left_out(spark):
    rows = [(2**53 + 1, 1.0, 1, False), (None, 1.0, 2, True), (2**53 + 1, None, 3, False), (2**53 + 1, 2.0, 4, False)]
    log = breaker_log(spark.createDataFrame(rows, "service long, t double, id long, ok boolean"), 2, 10.0)
    assert sorted((r.service or 0, r.id, r.state) for r in log.collect()) == [(0, 2, "closed"), (2**53 + 1, 1, "closed"), (2**53 + 1, 4, "open")]


def test_preset_breakers_deal_slices_whole(spark):
    """Services with settings of their own and without, where joins aren't broadcast by plan."""
    own = {"duckduckgo": (3, 600.0), "icebreaker": (2, 900.0), "other": (3, 300.0)}
    calls = [(s, i * 37.0, i, i * 13 % 5 < 2) for i in range(1500) for s in own]
    df = spark.createDataFrame(sorted(calls, key=lambda r: r[2] * 7919 % 1500), "service string, t double, id long, ok boolean").repartition(6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        log = preset_breaker_log(df)
        dealt = [line for line in log._jdf.queryExecution().executedPlan().toString().splitlines() if "REPARTITION_BY_COL" in line]
        got = {(r.service, r.id): r[1:] for r in log.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(s, x[1]): x for s, (most, wait) in own.items() for x in machine(sorted(r[1:] for r in calls if r[0] == s), most, wait)[0]}
    assert sum("slice#" in line for line in dealt) == 2


@pytest.mark.parametrize("name", ["preset_breaker_states", "breaker_states"])
def test_times_do_not_follow_the_sessions_zone(spark, tmp_path, name):
    """Calls over the hours that New York's clock leaves out in March and has twice in November."""
    con = duckdb.connect()
    con.execute("""CREATE TABLE events AS SELECT i AS event_id, ts, i % 4 AS user_id, CASE WHEN i * 7919 % 11 < 6 THEN 'error' ELSE 'view' END AS event_type, 0.5 AS value, '{}' AS props
        FROM (SELECT i, CASE WHEN i % 2 = 0 THEN TIMESTAMP '2024-03-10 00:00:00' ELSE TIMESTAMP '2024-11-03 00:00:00' END + to_microseconds(i * 7000001) AS ts FROM range(4000) r(i)) AS made""")
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = sorted(map(tuple, catalogue.queries()[name](spark, str(tmp_path)).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == sorted(con.sql(catalogue.oracle_sql()[name]).fetchall())
