"""The corpus pipeline: quality, near-duplicates, benchmark passages, source mixture, token ids.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept; ``run``
writes every stage's result as Parquet to the shared folder and reads it again, so a lost executor
costs one stage at most. All stages but the last return the columns of ``documents``.

The mixture repeats documents of sources that are short of their target and cuts the last one at the
budget; the last stage writes all of these copies in ascending doc_id order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from depthloom.llm import decontaminate, mixing, neardup, quality, tokenids
from depthloom.llm.common import stored, table
from depthloom.llm.queries import tokenizer_path


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenids.digest(docs, tokenids.Params(tokenizer_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The hashed models and the tokenizer are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
