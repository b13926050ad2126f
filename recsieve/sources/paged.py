"""A source that is read page by page: spark.read.format("paged").

A client (the option `client`, as module:function, called with the option `args`, a JSON object) stands for a service that gives rows by
pages. It says which parts can be read apart, and each part is read by a task of its own, page after page, from the cursor that the page
before gave. Filters on columns that the client can filter by are pushed down to it, so that rows that don't match aren't fetched;
others stay with Spark. Only the columns of the schema that was given are asked for. What a task holds is a page.

A client has `columns` (names that it filters by), `parts(conditions)`, a list of what names a part, and `page(part, cursor, size, conditions, names)`,
which gives rows as tuples and the next cursor, or null at the end; the first cursor is null. A condition is (name, operator,
value). A page may be empty and have a next cursor. A task that is run again reads its part again from the start.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.types import StructType

PAGE = 100
OPERATORS = {D.EqualTo: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}
Condition = tuple[str, str, Any]


class Client(Protocol):
    columns: list[str]

    def parts(self, conditions: list[Condition]) -> list[Any]: ...

    def page(self, part: Any, cursor: Any, size: int, conditions: list[Condition], names: list[str]) -> tuple[list[tuple], Any]: ...


@dataclass
class Part(D.InputPartition):
    value: Any


class PagedReader(D.DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        module, name = options["client"].split(":")
        self.made, self.args = getattr(importlib.import_module(module), name), json.loads(options.get("args", "{}"))
        self.names, self.size = schema.names, int(options.get("page_size", PAGE))
        self.conditions: list[Condition] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        columns = self.made(**self.args).columns
        for f in filters:
            if type(f) in OPERATORS and len(f.attribute) == 1 and f.attribute[0] in columns:
                self.conditions.append((f.attribute[0], OPERATORS[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[Part]:
        return [Part(x) for x in self.made(**self.args).parts(self.conditions)]

    def read(self, partition: Part | None) -> Iterator[tuple]:
        if partition is None:  # there are no parts
            return
        client, cursor = self.made(**self.args), None
        while True:
            rows, cursor = client.page(partition.value, cursor, self.size, self.conditions, self.names)
            yield from rows
            if cursor is None:
                return


class PagedSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        raise ValueError("the paged source needs a schema")

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, dict(self.options))


def read_paged(spark: SparkSession, client: str, schema: str, page_size: int = PAGE, **args: Any) -> DataFrame:
    """The rows of a paged source. Lets Spark push filters to Python sources in this session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").schema(schema).options(client=client, args=json.dumps(args), page_size=page_size).load()


class ParquetPages:
    """Pages of a Parquet file that all machines reach: each row group is a part, a cursor the next row in it. Row groups whose statistics
    rule out a condition are no parts."""

    def __init__(self, path: str, columns: list[str]):
        self.file, self.columns, self.held = pq.ParquetFile(path), columns, None

    def parts(self, conditions: list[Condition]) -> list[int]:
        return [i for i in range(self.file.num_row_groups) if all(self._may(i, c) for c in conditions)]

    def _may(self, group: int, condition: Condition) -> bool:
        name, operator, value = condition
        meta = self.file.metadata.row_group(group)
        column = next(meta.column(i) for i in range(meta.num_columns) if meta.column(i).path_in_schema == name)
        s = column.statistics
        if s is None or not s.has_min_max:
            return True
        return {"=": s.min <= value <= s.max, ">": s.max > value, ">=": s.max >= value, "<": s.min < value, "<=": s.min <= value}[operator]

    def page(self, part: int, cursor: int | None, size: int, conditions: list[Condition], names: list[str]) -> tuple[list[tuple], int | None]:
        if self.held is None or self.held[0] != part:
            found = self.file.read_row_group(part, columns=list(dict.fromkeys([*names, *(c[0] for c in conditions)])))
            for name, operator, value in conditions:
                column = found.column(name)
                compare = {"=": pc.equal, ">": pc.greater, ">=": pc.greater_equal, "<": pc.less, "<=": pc.less_equal}[operator]
                found = found.filter(compare(column, pa.scalar(value, column.type)))
            self.held = (part, found)
        found, at = self.held[1], cursor or 0
        rows = found.slice(at, size)
        return list(zip(*(rows.column(n).to_pylist() for n in names))), at + size if at + size < found.num_rows else None
