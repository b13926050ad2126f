"""The stateful operators on streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from recsieve.operators.qa import validate_pages
from recsieve.sources.stored import StoredTable


def validated_stream(pages: DataFrame) -> DataFrame:
    """Pages with status and issues as they arrive: the batch rules, row by row."""
    return validate_pages(pages)


def first_of_key(deals: DataFrame, key: str = "report_key", time: str = "seen_at", late: str = "30 days") -> DataFrame:
    """The first row of each key while its watermark lasts; state is bounded by `late`."""
    return deals.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def breaker_stream(calls: DataFrame, threshold: int, reset_after: float) -> DataFrame:
    """Per call whether its service's breaker let it pass, and failures and state after it, in order within each batch."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fails, last, is_open = state.get if state.exists else (0, 0.0, False)
        rows = pd.concat(list(batches)).sort_values(["t", "id"])
        out = []
        for t, i, ok in zip(rows["t"], rows["id"], rows["ok"]):
            allowed = not is_open or t - last >= reset_after
            if allowed and ok:
                fails, is_open = 0, False
            elif allowed:
                fails, last = fails + 1, float(t)
                is_open = fails >= threshold
            out.append((key[0], t, i, bool(allowed), fails, "open" if is_open else "closed"))
        state.update((int(fails), float(last), bool(is_open)))
        yield pd.DataFrame(out, columns=["service", "t", "id", "allowed", "fails", "state"])

    return calls.groupBy("service").applyInPandasWithState(run, "service long, t double, id long, allowed boolean, fails int, state string", "fails int, last double, open boolean", "append", GroupStateTimeout.NoTimeout)


def error_counts(calls: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Failures by service and tumbling window, late rows within the watermark included. Needs a column ts."""
    return calls.withWatermark("ts", late).groupBy(F.window("ts", width), "service").agg(F.count_if(~F.col("ok")).alias("n_failed"), F.count("*").alias("n_calls"))


def write_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """All that is there now, in micro-batches given to `each`; restartable from the checkpoint folder."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_batches(stream: DataFrame, table: StoredTable, checkpoint: str, name: str, order: Column | None = None, insert_only: bool = False) -> StreamingQuery:
    """Creates or updates a stored table's rows by key, each micro-batch exactly once.

    A micro-batch has the id `name:number` in the table: one that is given again, because the run died before the stream's own
    checkpoint knew of it, is left out. `name` is the stream's and stays the same as long as its checkpoint does.
    """
    return write_batches(stream, lambda rows, number: table.upsert(rows, order, f"{name}:{number}", insert_only) and None, checkpoint)
