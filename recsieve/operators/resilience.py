"""Circuit breakers, retries and fallbacks."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Breakers by service, and the errors that are worth a retry.
BREAKERS = [("duckduckgo", 3, 600), ("grok", 3, 300), ("clay", 3, 300), ("icebreaker", 2, 900)]
RETRYABLE = ["ConnectionError", "TimeoutError", "Timeout", "ReadTimeout", "ConnectTimeout", "MaxRetryError"]


def breakers(spark: SparkSession) -> DataFrame:
    """service, threshold, reset_after: the breakers that are set from the start."""
    return spark.createDataFrame(BREAKERS, "service string, threshold int, reset_after int")


def preset_breaker_log(calls: DataFrame, others: tuple[int, float] = (3, 300.0)) -> DataFrame:
    """breaker_log() with each service's own threshold and reset, by its name; other services have those of `others`."""
    known = breakers(calls.sparkSession).withColumnRenamed("service", "_service")
    rows = calls.join(F.broadcast(known), F.col("service").eqNullSafe(F.col("_service")), "left")
    return breaker_log(rows.drop("_service").withColumns({"threshold": F.coalesce("threshold", F.lit(others[0])), "reset_after": F.coalesce("reset_after", F.lit(others[1])).cast("double")}))


def _by_slice(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows with the columns that table has for their service and slice."""
    named = table.withColumnsRenamed({"service": "_service", "slice": "_slice"})
    return rows.join(named, F.col("service").eqNullSafe(F.col("_service")) & F.col("slice").eqNullSafe(F.col("_slice"))).drop("_service", "_slice")


class SliceMap:
    """What a slice of calls makes of every state that a breaker can be in at its start.

    A closed breaker has 0 to `most` - 1 failures. An open one does nothing until the first call that comes `wait` or more after
    its last failure, and how it goes on depends on which call that is. So there is a course for each number of failures (numbered
    -1, -2, ...) and for each call that may be that first one (numbered 0, 1, ...). Courses in the same state go on as one: those that a success
    closes meet at once. An open course rests until its own time has come, so a call touches the closed courses and those that it wakes.
    """

    def __init__(self, most: int, wait: float):
        self.most, self.wait = most, wait
        self.times: list[float] = []  # of calls that may be the first one
        self.more = True  # whether later ones may be
        self.closed: dict[int, list[int]] = {f: [-1 - f] for f in range(most)}
        self.open: deque[tuple[float, dict[tuple[int, bool], list[int]]]] = deque()  # by last failure: courses by failures, which add to the start's or not

    def add(self, t: float, ok: bool) -> None:
        woken: dict[tuple[int, bool], list[int]] = {}
        while self.open and t - self.open[0][0] >= self.wait:
            for key, courses in self.open.popleft()[1].items():
                woken[key] = _joined(woken.get(key, []), courses)
        if self.more and t not in self.times[-1:]:  # of calls at one time, the first one would have been it
            woken[0, True] = _joined(woken.get((0, True), []), [len(self.times)])
            self.times.append(t)
            self.more = t - self.times[0] < self.wait
        if ok:
            whole: list[int] = []
            for courses in (*self.closed.values(), *woken.values()):
                whole = _joined(whole, courses)
            self.closed = {0: whole} if whole else {}
            return
        failed = {(n + 1, own): courses for (n, own), courses in woken.items()}
        if self.most - 1 in self.closed:
            failed[self.most, False] = _joined(failed.get((self.most, False), []), self.closed.pop(self.most - 1))
        self.closed = {n + 1: courses for n, courses in self.closed.items()}
        if failed:
            self.open.append((t, failed))

    def rows(self) -> list[tuple[int, float, int, float, bool, bool]]:
        """(kind, start, fails, last, is_open, own): how a breaker ends that is closed (kind 0) with `start` failures, or open (kind 1) and woken
        by the call at `start` or any after the row before. `own`: fails add to what it had."""
        ends = {course: (n, 0.0, False, False) for n, courses in self.closed.items() for course in courses}
        ends |= {course: (n, last, True, own) for last, groups in self.open for (n, own), courses in groups.items() for course in courses}
        out = [(0, float(f), *ends[-1 - f]) for f in range(self.most)]
        for i, t in enumerate(self.times):
            if i + 1 == len(self.times) or ends[i] != ends[i + 1]:
                out.append((1, t, *ends[i]))
        return out


def _joined(a: list[int], b: list[int]) -> list[int]:
    """Both lists as one: the shorter is added to the longer."""
    if len(a) < len(b):
        a, b = b, a
    a.extend(b)
    return a


def _slice_maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Calls in order of group, slice and time: the maps of all slices, each made in one stream."""
    now, made, names = None, None, ["g", "slice", "reset_after", "kind", "start", "fails", "last", "is_open", "own"]
    done = lambda: [(*now, *row) for row in made.rows()] if made else []
    for batch in batches:
        out = []
        for g, x, t, ok, most, wait in zip(*(batch[c] for c in ("g", "slice", "t", "ok", "threshold", "reset_after"))):
            if now is None or (g, x) != now[:2]:
                out += done()
                now, made = (g, x, wait), SliceMap(most, wait)
            made.add(t, ok)
        yield pd.DataFrame(out, columns=names)
    yield pd.DataFrame(done(), columns=names)


def _starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Maps in order of group, slice, kind and start: each group's state at the start of its slices, slice by slice."""
    group, at, state, end = None, None, (0, 0.0, False), None
    for batch in batches:
        out = []
        for g, x, wait, kind, start, fails, last, is_open, own in zip(*(batch[c] for c in batch.columns)):
            if g != group:
                group, at, state, end = g, None, (0, 0.0, False), None
            if x != at:
                at, state, end = x, end or state, None  # an open breaker that no call of the slice wakes stays as it is
                out.append((g, x, *state))
            if end is None and (start - state[1] >= wait if state[2] else start == state[0]) and bool(kind) == state[2]:
                end = (fails + (state[0] if own else 0), last, is_open)
        yield pd.DataFrame(out, columns=["g", "slice", "s_fails", "s_last", "s_open"])


def _replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Calls in order of group, slice and time, each slice led by a row with the state at its start: what a breaker does with each call."""
    state = (0, 0.0, False)
    for batch in batches:
        out = []
        for g, call, t, i, ok, most, wait, *start in zip(*(batch[c] for c in ("g", "call", "t", "id", "ok", "threshold", "reset_after", "s_fails", "s_last", "s_open"))):
            if not call:
                state = tuple(start)
                continue
            fails, last, is_open = state
            allowed = not is_open or t - last >= wait
            if allowed:
                state = (0, 0.0, False) if ok else (fails + 1, t, fails + 1 >= most)
            out.append((g, t, i, allowed, state[0], "open" if state[2] else "closed"))
        yield pd.DataFrame(out, columns=["g", "t", "id", "allowed", "fails", "state"])


def breaker_log(calls: DataFrame, threshold: int | None = None, reset_after: float | None = None, slice_s: float = 3600.0) -> DataFrame:
    """Per call (service, t in seconds, id, ok): whether it was allowed, and failures and state after it.

    A denied call has no outcome. A breaker opens at `threshold` failures in a row, is half open (all calls pass) once
    `reset_after` seconds have gone by since the last failure, closes on success, and opens again on a failure. Without these two,
    calls have them as columns, the same for all of a service. Each call depends on the one before. So slices of time are read apart: each
    gives a map from any state at its start to the one at its end, the maps of a service are put together in order, and each
    slice is then read again from the state that it starts in. A task has a slice's calls, or a service's maps, as a stream; what it holds
    is a slice's courses. That state comes as a row ahead of the slice's calls and not by a join: a join by service and slice deals rows
    as the reading needs them, so Spark leaves out the exchange after it, and may then split a slice among tasks, as joins allow.
    Calls without a time are left out.
    """
    own = {"threshold": F.lit(threshold) if threshold is not None else F.col("threshold"), "reset_after": F.lit(reset_after) if reset_after is not None else F.col("reset_after")}
    rows = calls.select("service", "t", "id", "ok", own["threshold"].cast("int").alias("threshold"), own["reset_after"].cast("double").alias("reset_after"))
    # a text for each service, null too, to tell groups apart by
    rows = rows.withColumns({"g": F.coalesce(F.concat(F.lit("="), F.col("service").cast("string")), F.lit("")), "slice": F.floor(F.col("t") / slice_s)})
    rows = rows.where("t is not null").withColumn("call", F.lit(True))
    ordered = lambda df: df.repartition("g", "slice").sortWithinPartitions("g", "slice", "call", "t", "id")
    maps = ordered(rows.drop("service")).mapInPandas(_slice_maps, "g string, slice long, reset_after double, kind int, start double, fails int, last double, is_open boolean, own boolean")
    starts = maps.repartition("g").sortWithinPartitions("g", "slice", "kind", "start").mapInPandas(_starts, "g string, slice long, s_fails int, s_last double, s_open boolean")
    none = {"t": "0D", "id": "0L", "ok": "false", "threshold": "0", "reset_after": "0D"}
    led = starts.withColumns({c: F.expr(v) for c, v in none.items()} | {"call": F.lit(False)})
    own_calls = rows.drop("service").withColumns({"s_fails": F.lit(0), "s_last": F.lit(0.0), "s_open": F.lit(False)})
    log = ordered(led.unionByName(own_calls)).mapInPandas(_replay, "g string, t double, id long, allowed boolean, fails int, state string")
    kind = calls.schema["service"].dataType
    return log.select(F.when(F.col("g") != "", F.expr("substring(g, 2)")).cast(kind).alias("service"), "t", "id", "allowed", "fails", "state")


def breaker_summary(log: DataFrame) -> DataFrame:
    """Per service: calls let through and denied, and how the breaker stands at the end."""
    last = F.max(F.struct("t", "id", "fails", "state"))
    out = log.groupBy("service").agg(F.count_if("allowed").alias("n_allowed"), F.count_if(~F.col("allowed")).alias("n_denied"), last.alias("x"))
    return out.select("service", "n_allowed", "n_denied", F.col("x.fails").cast("long").alias("fails"), "x.state")


def failure_runs(calls: DataFrame, slice_s: float = 3600.0) -> DataFrame:
    """Each run of failures in a row by service: its first call (the least id) and its length (gaps and islands).

    A run's number is how many calls succeeded before it. They are counted within slices of time, and slices are added up on their
    own, so no task sorts a whole service.
    """
    sliced = calls.withColumn("slice", F.floor(F.col("t") / slice_s))
    here = F.sum(F.col("ok").cast("int")).over(Window.partitionBy("service", "slice").orderBy("t", "id"))
    totals = sliced.groupBy("service", "slice").agg(F.sum(F.col("ok").cast("int")).alias("n"))
    before = totals.select("service", "slice", (F.sum("n").over(Window.partitionBy("service").orderBy("slice")) - F.col("n")).alias("before"))
    rows = _by_slice(sliced.withColumn("here", here).where("not ok"), before)
    return rows.groupBy("service", (F.col("before") + F.col("here")).alias("island")).agg(F.min("id").alias("first_id"), F.count("*").alias("run_length")).drop("island")


def backoff(retries: Column, base: Column) -> Column:
    """Seconds waited before each retry."""
    return F.when(retries > 0, F.transform(F.sequence(F.lit(0), retries - 1), lambda i: base * F.pow(F.lit(2.0), i))).otherwise(F.array().cast("array<double>"))


def retry_class(error: Column) -> Column:
    return F.when(error.isin(RETRYABLE), "retry").otherwise("fallback")
