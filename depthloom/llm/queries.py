"""Queries over the corpus tables: an entry for each operator and for the pipeline, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom.llm import decontaminate, hilbert, linetemplates, mixing, neardup, pii, quality, recompress, runs, sharding, sql, tokenids, toxicity
from depthloom.llm.common import table

SHARDS = 40


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.digest(table(spark, sf_dir, "documents"), tokenids.Params(tokenizer_path()))


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"), pii.default_model(pii.Params()))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"))


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linetemplates.remove(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.Tree.even(SHARDS))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [pipeline, op1_token_ids, op2_nearest_vectors, op3_decontamination, op4_personal_data, op5_near_duplicates, op6_line_templates, op7_sharding, op8_quality, op9_mixing, op10_substrings, op11_periodic_runs, op12_toxicity]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    tree = sharding.Tree.even(SHARDS)
    lines = linetemplates.Params()
    return {
        "op3_decontamination": sql.OP3,
        "op5_near_duplicates": sql.OP5,
        "op6_line_templates": sql.op6(lines.depth, lines.share, lines.similar, lines.documents),
        "op7_sharding": sql.op7(tree.regions, tree.grown().regions, tree.seed),
        "op9_mixing": sql.OP9,
        "op10_substrings": sql.OP10,
    }
