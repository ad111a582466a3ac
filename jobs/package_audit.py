"""Audit of a delivered package of texts: manifest, checks and label coverage, partitioned by source.

Someone who packs a data set wants to know, before it is trained on, that every listed item is there, that each has
the size that was declared for it, which items are copies, which are far smaller than the rest of their source, and which have
no label. This job reads the package's items (``documents``) and its list of labels (``labels``), writes one
manifest row an item, with its size, hash, first copy and finding, and beside it a small report of findings by source.

    python jobs/package_audit.py --config jobs/package_audit.json --documents IN --labels IN --out OUT

Output: ``OUT/manifest`` (Parquet, a partition a source) and ``OUT/report`` (JSON lines: source, issue, items, bytes).
Findings, the first that applies: ``missing`` (labelled, but no item), ``no_text``, ``size`` (another number of
characters than declared), ``empty`` (no words), ``copy`` (an item with a smaller id has the same text), ``low_count`` (fewer
words than ``low_share`` of the median of its source), else ``ok``.

A rerun overwrites both outputs with the same rows: nothing depends on time or on what was there before. An item id that comes
several times is kept once, the row with the greatest (source, hash, declared size).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom import logs
from depthloom.operators import chain, quality

WORD = r"[^\x20\x09-\x0D]+"
COLUMNS = ["item", "source", "bytes", "words", "md5", "first_copy", "labelled", "issue"]


@dataclass(frozen=True)
class Params:
    documents: str = ""
    labels: str = ""
    out: str = ""
    low_share: float = 0.05
    salts: int = 32


def items(documents: DataFrame) -> DataFrame:
    """One measured row an item id; texts go no further than this projection."""
    said = documents.where("doc_id is not null").select(
        F.col("doc_id").alias("item"),
        "source",
        F.md5(F.col("text")).alias("md5"),
        F.octet_length("text").cast("long").alias("bytes"),
        F.length("text").cast("long").alias("chars"),
        F.col("n_chars").alias("declared"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    row = F.max(F.struct("source", "md5", "declared", "bytes", "chars", "words")).alias("r")
    return said.groupBy("item").agg(row).select("item", "r.*")


def first_copies(rows: DataFrame, salts: int) -> DataFrame:
    """Adds the least item id with the same hash. A text that fills much of the package is spread over ``salts`` tasks."""
    least = rows.where("md5 is not null").groupBy("md5").agg(F.min("item").alias("first_copy"), F.count(F.lit(1)).alias("n")).where("n > 1")
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).drop("n")
    return rows.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(salts)).cast("int")).join(spread, ["md5", "salt"], "left").drop("salt")


def manifest(documents: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    rows = first_copies(items(documents), p.salts)
    listed = labels.where("doc_id is not null").select(F.col("doc_id").alias("item")).distinct().withColumn("labelled", F.lit(True))
    known = rows.join(listed, "item", "left").withColumn("labelled", F.coalesce("labelled", F.lit(False)))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in known.dtypes if c not in ("item", "labelled")]
    absent = chain.missing(listed, documents.where("doc_id is not null").select(F.col("doc_id").alias("item")), ["item"])
    medians = quality.percentiles(rows, "words", {"median": 0.5}, by=["source"]).withColumnRenamed("source", "_source")
    both = known.unionByName(absent.select("item", "labelled", *nothing).withColumn("words", F.lit(-1).cast("long")))
    seen = both.join(F.broadcast(medians), F.col("source").eqNullSafe(F.col("_source")), "left")  # a row a source, see run()
    issue = (
        F.when(F.col("words") == -1, "missing")
        .when(F.col("md5").isNull(), "no_text")
        .when(F.col("declared") != F.col("chars"), "size")
        .when(F.col("words") == 0, "empty")
        .when(F.col("first_copy") < F.col("item"), "copy")
        .when(F.col("words") < F.col("median") * p.low_share, "low_count")
        .otherwise("ok")
    )
    return seen.withColumn("issue", issue).withColumn("words", F.nullif("words", F.lit(-1))).select(*COLUMNS)


def run(spark: SparkSession, p: Params) -> DataFrame:
    """Runs the audit and returns the manifest as written."""
    log = logs.logger("depthloom.jobs")
    documents, labels = spark.read.parquet(p.documents), spark.read.parquet(p.labels)
    found = manifest(documents.select("doc_id", "source", "text", "n_chars"), labels, p)
    # a task writes few partitions, and a large source is written by several tasks
    dealt = found.repartition("source", F.pmod(F.xxhash64("item"), F.lit(8)))
    dealt.write.mode("overwrite").partitionBy("source").parquet(f"{p.out}/manifest")
    schema = found.schema
    written = spark.read.schema(schema).parquet(f"{p.out}/manifest")
    report = written.groupBy("source", "issue").agg(F.count(F.lit(1)).alias("items"), F.sum("bytes").alias("bytes")).orderBy(F.col("source").asc_nulls_last(), "issue")
    report.write.mode("overwrite").json(f"{p.out}/report")
    tally = {r.issue: r.n for r in written.groupBy("issue").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most seven rows
    log.info("read %s and %s", p.documents, p.labels)
    log.info("wrote %d manifest rows to %s/manifest, their findings %s to %s/report", sum(tally.values()), p.out, dict(sorted(tally.items())), p.out)
    return written.select(*COLUMNS)


#: What the manifest holds, for DuckDB; ``low_share`` as by default.
SQL = r"""
WITH said AS (
  SELECT doc_id AS item, source, md5(text) AS md5, n_chars AS declared, octet_length(encode(text))::BIGINT AS bytes, length(text)::BIGINT AS chars,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words
  FROM documents WHERE doc_id IS NOT NULL),
item AS (
  SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY item ORDER BY source DESC NULLS LAST, md5 DESC NULLS LAST, declared DESC NULLS LAST) = 1),
seen AS (
  SELECT i.*, min(item) OVER (PARTITION BY md5) AS least, count(*) OVER (PARTITION BY md5) AS n,
    quantile_cont(words, 0.5) OVER (PARTITION BY source) AS median,
    item IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) AS labelled
  FROM item i)
SELECT item, source, bytes, words, md5, CASE WHEN md5 IS NOT NULL AND n > 1 THEN least END AS first_copy, labelled,
  CASE WHEN md5 IS NULL THEN 'no_text' WHEN declared <> chars THEN 'size' WHEN words = 0 THEN 'empty'
    WHEN n > 1 AND least < item THEN 'copy' WHEN words < median * 0.05 THEN 'low_count' ELSE 'ok' END AS issue
FROM seen
UNION ALL
SELECT DISTINCT doc_id, NULL, NULL, NULL, NULL, NULL, TRUE, 'missing' FROM labels
WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)
"""


if __name__ == "__main__":
    from jobs.common import command_line

    command_line(Params, run, __doc__.splitlines()[0])
