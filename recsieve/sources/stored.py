"""Stored tables that rows are created and updated in by key, without rewriting the rest.

A stored table keeps its rows in Parquet by partitions, a hash of the key. Each version is a small Parquet list of the folder that each
partition's rows are in; such folders never change. An upsert joins the given rows with the partitions that their keys fall into, writes
those of them that change to new folders, and then renames the next list into place: readers see the table as it was or as it is.
A writer that dies before that leaves folders that no list names. A batch may carry an id, which the version that took it in lists
too: given again, it changes nothing. One writer at a time: a second one whose version is there already gets an error.

The number of partitions stays as it was when the table was made, and is listed with it: choose it for partitions of some hundred MB.

Nulls: a null key is a key like others. Ties: of several rows of one key in a batch, that with the greatest `order` counts, and of those the
greatest row. Rows that are given again, or an empty batch, change nothing. Columns that a batch lacks keep their values in rows that are
there, and are null in new ones; columns that only a batch has are null in other rows. `_part` and `_gone` can't be
columns' names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART, GONE = "_part", "_gone"
MANIFEST = "part int, folder string, batches array<string>"


@dataclass(frozen=True)
class StoredTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    partitions: int = 64

    def _file(self, at: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def version(self) -> int:
        """The last version's number; -1 before the first."""
        fs, path = self._file(f"{self.path}/versions")
        return max((int(s.getPath().getName()) for s in fs.listStatus(path)), default=-1) if fs.exists(path) else -1

    def _listed(self, version: int) -> tuple[dict[int, str], list[str], int]:
        """Each partition's folder, the batches taken in, and how many partitions keys fall into."""
        if version < 0:
            return {}, [], self.partitions
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/versions/{version}").collect()
        whole = next(r for r in rows if r.part < 0)
        return {r.part: r.folder for r in rows if r.part >= 0}, whole.batches, int(whole.folder)

    def _rows(self, folders: list[str]) -> DataFrame | None:
        return self.spark.read.option("mergeSchema", "true").parquet(*(f"{self.path}/rows/{f}" for f in folders)) if folders else None

    def read(self, version: int | None = None) -> DataFrame:
        """The table as it is, or as it was at a version."""
        rows = self._rows(list(self._listed(self.version() if version is None else version)[0].values()))
        if rows is None:
            raise FileNotFoundError(f"no rows at {self.path}")
        return rows

    def _add_version(self, version: int, folders: dict[int, str], batches: list[str], partitions: int) -> None:
        made = f"{self.path}/making/{uuid.uuid4().hex}"
        self.spark.createDataFrame([*((p, f, []) for p, f in folders.items()), (-1, str(partitions), batches)], MANIFEST).coalesce(1).write.parquet(made)
        fs, to = self._file(f"{self.path}/versions/{version}")
        fs.mkdirs(to.getParent())
        if fs.exists(to) or not fs.rename(self._file(made)[1], to):
            raise RuntimeError(f"{self.path} has a version {version} already: another writer was first")

    def _keyed(self, rows: DataFrame, name: str, partitions: int) -> DataFrame:
        part = F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in self.keys)), F.lit(partitions)).cast("int")
        return rows.select(part.alias(PART), F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias(name))

    def upsert(self, rows: DataFrame, order: Column | None = None, batch: str | None = None, insert_only: bool = False, gone: str | None = None) -> list[int]:
        """Creates rows whose keys aren't there and updates those whose keys are; with insert_only, the latter stay as they are.

        `gone` names a boolean column of the given rows that isn't kept: where it is true, the row of that key is deleted. Gives the
        partitions that changed.
        """
        version = self.version()
        folders, batches, partitions = self._listed(version)
        if batch is not None and batch in batches:
            return []
        last = F.struct(order if order is not None else F.lit(0), F.struct(*(F.col(f"`{c}`") for c in rows.columns)))
        new = rows.groupBy(*(F.col(f"`{k}`") for k in self.keys)).agg(F.max(last).alias("_last")).select("_last.col2.*")
        new = new.withColumn(GONE, F.coalesce(F.col(f"`{gone}`"), F.lit(False)) if gone else F.lit(False))
        new, rows = self._keyed(new.drop(gone) if gone else new, "new", partitions), rows.drop(gone) if gone else rows
        parts = [r[0] for r in new.select(PART).distinct().collect()]  # no more than the table has partitions
        old = self._rows([folders[p] for p in parts if p in folders])
        had = [] if old is None else old.columns
        names = [*had, *(c for c in rows.columns if c not in had)]
        deleted = F.coalesce(F.col(f"new.{GONE}"), F.lit(False))
        if old is None:
            both = new.withColumn("old", F.lit(None).cast("struct<x:int>"))
        else:
            held = self._keyed(old, "old", partitions).withColumnRenamed(PART, "_held")
            on = F.col("_held") == F.col(PART)
            for k in self.keys:
                on = on & F.col(f"old.`{k}`").eqNullSafe(F.col(f"new.`{k}`"))
            both = held.join(new, on, "full").withColumn(PART, F.coalesce(PART, "_held"))
        there, given = F.col("old").isNotNull(), F.col("new").isNotNull()
        take = (given & ~there) if insert_only else given

        def value(c: str) -> Column:
            before = F.when(there, F.col(f"old.`{c}`")) if c in had else F.lit(None).cast(rows.schema[c].dataType)
            return F.when(take, F.col(f"new.`{c}`")).otherwise(before) if c in rows.columns else before

        out = both.select(PART, "old", deleted.alias(GONE), F.struct(*(value(c).alias(c) for c in names)).alias("row"))
        before = F.struct(*((F.when(there, F.col(f"old.`{c}`")) if c in had else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for c in names))
        changed = [r[0] for r in out.where(F.when(F.col(GONE), there).otherwise(~there | ~before.eqNullSafe(F.col("row")))).select(PART).distinct().collect()]
        if changed:
            folder = uuid.uuid4().hex
            out.where(F.col(PART).isin(changed) & ~F.col(GONE)).select(PART, "row.*").repartition(len(changed), PART).write.partitionBy(PART).parquet(f"{self.path}/rows/{folder}")
            filled = {r[0] for r in out.where(F.col(PART).isin(changed) & ~F.col(GONE)).select(PART).distinct().collect()}
            folders = {p: f for p, f in folders.items() if p not in changed} | {p: f"{folder}/{PART}={p}" for p in filled}
        if changed or batch is not None:
            self._add_version(version + 1, folders, batches if batch is None else [*batches, batch], partitions)
        return sorted(changed)
