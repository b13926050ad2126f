"""Remote calls from partitions: retries with backoff, a breaker per worker, fallbacks. The client is injected."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsieve.operators.resilience import BREAKERS, RETRYABLE


@dataclass
class Breaker:
    """Closed, open after `threshold` failures in a row, half open `reset_after` seconds after the last one."""

    threshold: int = 3
    reset_after: float = 300.0
    clock: Callable[[], float] = time.monotonic
    fails: int = 0
    last: float = field(default=0.0)
    is_open: bool = False

    @property
    def state(self) -> str:
        if not self.is_open:
            return "closed"
        return "half-open" if self.clock() - self.last >= self.reset_after else "open"

    def allows(self) -> bool:
        return self.state != "open"

    def success(self) -> None:
        self.fails, self.is_open = 0, False

    def failure(self) -> None:
        self.fails, self.last = self.fails + 1, self.clock()
        self.is_open = self.is_open or self.fails >= self.threshold


def resilient_call(fn: Callable[[], object], breaker: Breaker | None = None, retries: int = 2, base: float = 2.0, fallback: object = None, sleep: Callable[[float], None] = time.sleep, on_error: Callable[[Exception, int], None] | None = None) -> object:
    """fn(), tried again after retryable errors; the fallback after other errors, exhausted tries or while the breaker is open.

    on_error is told of each error and of the attempt's number, from 0; what it raises is its caller's matter.
    """
    if breaker and not breaker.allows():
        return fallback
    for attempt in range(retries + 1):
        try:
            value = fn()
        except Exception as e:  # what a client raises is its own matter
            if on_error:
                on_error(e, attempt)
            if type(e).__name__ in RETRYABLE or isinstance(e, (ConnectionError, TimeoutError)):
                if attempt < retries:
                    sleep(base * 2**attempt)
                    continue
            break
        if breaker:
            breaker.success()
        return value
    if breaker:
        breaker.failure()
    return fallback


def preset(service: str, clock: Callable[[], float] = time.monotonic) -> Breaker:
    """The breaker that is set for a service from the start; KeyError for one that has none."""
    threshold, reset_after = {name: (n, s) for name, n, s in BREAKERS}[service]
    return Breaker(threshold, float(reset_after), clock)


def call_each(rows: DataFrame, column: str, client: Callable[[str], str], out: str = "answer", fallback: str | None = None, service: str | None = None, key: str | None = "", **kwargs) -> DataFrame:
    """rows with client(value of column) per row, one breaker in each Python worker's partition: that of `service` if it is named.

    With key None (a service that wants a key, and none is set) the client isn't called and every answer is null.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        breaker = preset(service) if service else Breaker()
        for batch in batches:
            answers = [None if key is None else resilient_call(lambda x=x: client(x), breaker, fallback=fallback, **kwargs) for x in batch[column]]
            yield batch.assign(**{out: answers})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + f", `{out}` string"
    return rows.mapInPandas(run, schema)


def chat_answer(body: Column) -> Column:
    """The text of the first choice in a chat service's JSON answer; null without one."""
    return F.get_json_object(body, "$.choices[0].message.content")
