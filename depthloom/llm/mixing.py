"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets.

Every row gets a random key by hashing its doc_id. Within each source the rows are dealt
by key into ``2**(4*digits)`` ranges; range totals are summed, and a second window gives the
place of each row within its range, so no task sees a whole source. A source with a budget B
and a size S is read B // S whole times, and its rows in key order give the remaining B % S
words; the row at the cut gives the words up to the budget.

Targets: sources ordered by code point, null last, weigh 1, 2, 3, 1, 2, 3, ... of the size of
all; a target stops at 3 times its source's size, and the excess goes to the others by weight.
That rule's fixed point is target = min(3 * size, level * weight) for one common level.

Edge cases: null texts have size 0; a source without words has target 0; an empty table gives no
rows. Null doc_ids and repeated doc_ids share a key, and their order is by size, then a hash of the text.
The source table is one row a source and is ordered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthloom.llm.common import stored, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Params:
    weights: tuple[int, ...] = (1, 2, 3)
    cap: int = 3
    digits: int = 3
    seed: int = 9


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _key(p: Params) -> Column:
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{p.seed}")))


def targets(totals: DataFrame, p: Params) -> DataFrame:
    """From (source, source_size) to (source, source_size, target)."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("ratio", "place")
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in p.weights]), ((F.col("place") - 1) % len(p.weights) + 1).cast("int"))
    ranked = (
        totals.withColumn("place", F.row_number().over(order))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * p.cap)
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("most_before", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(whole) - F.col("most_before")) / F.col("weight_left"))
        .withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
        .withColumn("level", F.first("fits", ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    return ranked.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _mixed(docs: DataFrame, p: Params) -> tuple[DataFrame, list[str]]:
    """Documents with their columns as c0, c1, ... (whatever they are called) and size, source_size, target, taken."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    at = {name: own[i] for i, name in enumerate(docs.columns)}
    rows = (
        docs.toDF(*own)
        .withColumns({"doc_id": F.col(at["doc_id"]), "source": F.col(at["source"]), "size": size_of(text_or_empty(at["text"])), "tie": F.xxhash64(at["text"])})
        .withColumn("key", _key(p))
        .withColumn("range", F.substring("key", 1, p.digits))
    )
    ranges = stored(rows.groupBy("source", "range").agg(F.sum("size").alias("sum")), "mix-ranges")
    plan = targets(ranges.groupBy("source").agg(F.sum("sum").alias("source_size")), p)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        ranges.withColumn("base", F.coalesce(F.sum("sum").over(before), F.lit(0)))
        .join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select(F.col("source").alias("bs"), F.col("range").alias("br"), "base", "source_size", "target")
    )
    inner = Window.partitionBy("source", "range").orderBy("key", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(base, F.col("source").eqNullSafe(F.col("bs")) & (F.col("range") == F.col("br")))
    budget = F.round("target").cast("long")
    rest = budget % F.greatest("source_size", F.lit(1))
    whole = F.floor(budget / F.greatest("source_size", F.lit(1))).cast("long")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("base") - F.col("inner")))
    return placed.withColumn("taken", taken.cast("long")).select(*own, "size", "source_size", "target", "taken"), own


def mix(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Adds size, source_size, target and taken to the documents (columns doc_id, text, source needed).

    Columns of ``docs`` with those names are replaced.
    """
    mixed, own = _mixed(docs, p)
    made = ("size", "source_size", "target", "taken")
    return mixed.select(*[F.col(c).alias(name) for c, name in zip(own, docs.columns, strict=True) if name not in made], *made)


def apply(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each whole time that a document is
    taken, and one with the words up to the budget for a document that is cut."""
    mixed, own = _mixed(docs, p)
    text = own[docs.columns.index("text")]
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    parts = F.concat(F.array_repeat(F.lit(0), times), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1), 1, F.col("part")), " ")
    out = mixed.withColumn("part", F.explode(parts)).withColumn(text, F.when(F.col("part") > 0, head).otherwise(F.col(text)))
    return out.select(*own).toDF(*docs.columns)
