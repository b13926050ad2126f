"""Command line: checks pages, or cleans blocks, of Parquet tables. Without a target it prints its help and ends with 1."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsieve.operators import blocks as B
from recsieve.operators import qa
from recsieve.sources.stored import StoredTable

log = logging.getLogger("recsieve")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="recsieve", description=__doc__)
    p.add_argument("what", choices=["validate", "clean"])
    p.add_argument("table", help="Parquet path of the pages or blocks, or a stored table with --stored")
    p.add_argument("--page-id", help="one page")
    p.add_argument("--recent", type=int, metavar="HOURS", help="pages dated in the last HOURS hours")
    p.add_argument("--out", help="new Parquet path for the rows that were chosen")
    p.add_argument("--stored", action="store_true", help="the table is a stored one: results are put into it by key, all other rows stay")
    p.add_argument("--dry-run", action="store_true", help="report only")
    p.add_argument("--verbose", "-v", action="store_true")
    return p


def chosen(rows: DataFrame, args: argparse.Namespace) -> DataFrame:
    if args.page_id is not None:
        return rows.where(F.col("page_id").cast("string") == args.page_id)
    return rows.where(F.col("date") > F.current_timestamp() - F.make_interval(hours=F.lit(args.recent)))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 when done, 1 without a target. `clean` takes a page; blocks have no date."""
    p = parser()
    args = p.parse_args(argv)
    if args.page_id is None and (args.recent is None or args.what == "clean"):
        p.print_help()
        return 1
    logging.basicConfig(format="recsieve %(levelname)s: %(message)s")
    log.setLevel("DEBUG" if args.verbose else "INFO")
    spark = spark or SparkSession.builder.getOrCreate()
    stored = StoredTable(spark, args.table, ("page_id",) if args.what == "validate" else ("page_id", "pos"))
    rows = chosen(stored.read() if args.stored else spark.read.parquet(args.table), args)
    gone = None
    if args.what == "validate":
        out = qa.audited(rows, F.current_timestamp())
        log.info("statuses: %s", qa.status_json(qa.status_histogram(qa.validate_pages(rows))).first().stats)
    else:
        acted = B.block_actions(rows)
        log.info("actions: %s", {r.action: r["count"] for r in acted.groupBy("action").count().collect()})
        gone = "removed" if args.stored else None
        out = B.apply_actions(acted, keep_removed=gone)
    if args.dry_run:
        return 0
    if args.stored:
        log.debug("partitions changed: %s", stored.upsert(out, gone=gone))
    if args.out:
        out.write.mode("errorifexists").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
