"""Shards by a hierarchical weighted hash tree. Native: DataFrame functions only.

A tree has regions, a region racks, a rack shards. A row descends: each region draws -ln(u) / weight, u a
hash of doc_id and the region, weight the sum of its shards'; the least draw wins. Then the racks of that region
draw, each on its own hash, and at last the shards of that rack. A row costs as many hashes as the nodes on its way
have children, whatever the number of shards.

A draw changes only with its node's weight. So when the weights in one rack change, rows move only into or out of
that rack (and, where its region's weight changes too, that region): subtrees whose weights stay keep
exchanging nothing with each other. ``grown`` opens a region of its own for a new shard, so that rows move only into
the new shard. Added to an older rack it would raise the rack's weight, and some of the rows that the rack then
wins would go to its older shards.

Law ``key``: doc_id and the shard count decide. Slots number the rows of a shard gaplessly from 0
in the order of a hash of doc_id, then size, then CRC; range totals give each row's base, so
no task sees a whole shard.

Edge cases: null texts have size 16 and the CRC of nothing, 0; null doc_ids hash as the word null;
repeated doc_ids share a shard; texts of any length are only measured; a node of weight 0 gets no rows; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthloom.llm.common import stored, text_or_empty


@dataclass(frozen=True)
class Tree:
    """regions: weights of the shards by rack by region; shards are numbered in that order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]
    seed: int = 7

    @classmethod
    def even(cls, shards: int, shards_a_rack: int = 5, racks_a_region: int = 4, seed: int = 7) -> Tree:
        """Shards of weight 1, filled rack by rack and region by region."""
        racks = [(1.0,) * min(shards_a_rack, shards - i) for i in range(0, shards, shards_a_rack)]
        return cls(tuple(tuple(racks[i : i + racks_a_region]) for i in range(0, len(racks), racks_a_region)), seed)

    def grown(self, weight: float = 1.0) -> Tree:
        return Tree((*self.regions, ((float(weight),),)), self.seed)

    def first_numbers(self) -> list[list[int]]:
        """Number of the first shard of each rack, by region."""
        out, n = [], 0
        for region in self.regions:
            out.append([])
            for rack in region:
                out[-1].append(n)
                n += len(rack)
        return out


def _name() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))


def _nested(values: object) -> Column:
    return F.array(*[_nested(v) for v in values]) if isinstance(values, list | tuple) else F.lit(values)


def draw(node: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight, u from 48 bits of a hash of doc_id and the node's path."""
    bits = F.conv(F.substring(F.md5(F.concat(_name(), F.lit(f":{seed}:"), node)), 1, 12), 16, 10).cast("double")
    return F.when(weight > 0, -F.log((bits + 0.5) / float(2**48)) / F.when(weight > 0, weight)).otherwise(F.lit(float("inf")))


def _least(df: DataFrame, column: str, path: Column, weights: Column, seed: int) -> DataFrame:
    """Adds the index of the child that draws least; the children's paths are ``path`` and their index."""
    drawn = F.transform(weights, lambda w, i: draw(F.concat(path, i.cast("string")), w, seed))
    step = df.withColumn("_drawn", drawn)
    return step.withColumn(column, (F.array_position("_drawn", F.array_min("_drawn")) - 1).cast("int")).drop("_drawn")


def descend(df: DataFrame, tree: Tree, column: str) -> DataFrame:
    """Adds the shard of each row: least region, least rack in it, least shard in that."""
    region, rack = F.col("_r"), F.col("_k")
    step = _least(df, "_r", F.lit(""), _nested([float(sum(map(sum, racks))) for racks in tree.regions]), tree.seed)
    racks = F.get(_nested([[float(sum(shards)) for shards in racks] for racks in tree.regions]), region)
    step = _least(step, "_k", F.concat(region.cast("string"), F.lit(".")), racks, tree.seed)
    shards = F.get(F.get(_nested(tree.regions), region), rack)
    step = _least(step, "_s", F.concat(region.cast("string"), F.lit("."), rack.cast("string"), F.lit(".")), shards, tree.seed)
    first = F.get(F.get(_nested(tree.first_numbers()), region), rack)
    return step.withColumn(column, (first + F.col("_s")).cast("int")).drop("_r", "_k", "_s")


def number(df: DataFrame, group: str, order: list[str], column: str) -> DataFrame:
    """Adds gapless numbers from 0 within ``group``, in the order of ``order``, whose first is an md5.

    Rows are dealt by the first three hex digits; the ranges' counts give the bases.
    """
    dealt = df.withColumn("_range", F.substring(order[0], 1, 3))
    counts = dealt.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col(group).alias("_g"), F.col("_range").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = dealt.withColumn("_in", F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order)))
    joined = inner.join(base, (F.col(group) == F.col("_g")) & (F.col("_range") == F.col("_b")))
    return joined.withColumn(column, (F.col("_base") + F.col("_in") - 1).cast("long")).drop("_range", "_g", "_b", "_base", "_in")


def assign(docs: DataFrame, tree: Tree) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (with one more shard of weight 1)."""
    sized = docs.select("doc_id", (F.octet_length(text_or_empty()).cast("long") + 16).alias("size"), F.crc32(text_or_empty().cast("binary")).alias("text_crc32"))
    placed = descend(descend(sized, tree, "shard"), tree.grown(), "grown_shard").withColumn("_key", F.md5(F.concat(_name(), F.lit(f":{tree.seed}:slot"))))
    slots = number(stored(placed, "shards"), "shard", ["_key", "size", "text_crc32"], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
