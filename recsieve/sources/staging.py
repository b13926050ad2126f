"""Intermediate tables in the folder that a cluster's machines share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder, from spark.checkpoint.dir; where that is unset, a folder of the warehouse.

    On a cluster a warehouse in a local file system isn't shared: executors would write to their own disks. That raises an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        at = sc.getConf().get("spark.checkpoint.dir")
        if not at:
            at = spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
            path = sc._jvm.org.apache.hadoop.fs.Path(at)
            scheme = path.getFileSystem(sc._jsc.hadoopConfiguration()).getUri().getScheme()
            if scheme == "file" and not local(sc.master):
                raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share: {at} is on each machine's own disk")
        sc.setCheckpointDir(at)
    return sc.getCheckpointDir()


def local(master: str) -> bool:
    """Whether a master runs everything in one process."""
    return master == "local" or master.startswith("local[")


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept as a Parquet table in the shared checkpoint folder, with its lineage cut.

    A table in the folder that all executors share survives the loss of any of them, and is a third of a checkpoint()'s size.
    """
    spark = df.sparkSession
    at = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def remove(spark: SparkSession, tables: list[DataFrame]) -> None:
    """Deletes the files of tables that cut() made, once nothing reads them any more."""
    sc = spark.sparkContext
    shared = checkpoint_dir(spark)
    for at in {file.rsplit("/", 1)[0] for t in tables for file in t.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(at)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        if fs.makeQualified(path.getParent()) != fs.makeQualified(sc._jvm.org.apache.hadoop.fs.Path(shared)):
            raise ValueError(f"{at} isn't a table that cut() made")
        fs.delete(path, True)
