"""A training corpus from raw documents: stages that each take what the one before kept.

Rejected documents leave in the first three stages (low quality; near copies of a document that stays; documents with
benchmark windows). The fourth replaces secrets within texts, the fifth repeats small sources up to their weights. Each stage's
result is written as Parquet and reread. SQL can't express the stages (expectation-maximisation, signatures), so ORACLE_SQL
is None and tests hold the result against plain Python.

All stages: nulls in any column are kept as they are (a null text is empty, so the first stage rejects it; a null id or source is
like others), of rows equal in id and text one stays after the second stage, an empty table gives an empty one, a very long text is one
row that is read whole, and other columns stay, whatever their names. Ties: of near copies the least id stays; the last stage names what
it adds (n_tokens, epoch, weight, mix_order), which replaces columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recsieve.llm.common import cut
from recsieve.llm.decontaminate import clean
from recsieve.llm.mixing import mix
from recsieve.llm.near_dedup import deduplicate
from recsieve.llm.quality_rules import keep_good
from recsieve.llm.secrets import redact


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("mix_sources", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
