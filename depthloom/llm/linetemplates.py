"""Recurring lines by a log-template tree. Native: DataFrame functions only.

A line's tokens are the runs between spaces and tabs. The tree has a fixed depth: the number of tokens, then the
first ``depth`` tokens, where a token with a digit counts as variable. In a leaf, a place of the line is constant if
one token stands there in at least ``share`` of the leaf's lines, else variable; a line belongs to the
leaf's template if at least ``similar`` of its tokens are at constant places with that token, else it is a
template of its own, its tokens with digits being variable. A template that occurs in ``documents`` documents or more
is dropped from all of them; the first document keeps nothing of it either, as it is boilerplate.

Only leaves that enough documents share can hold such a template, so the tokens of all other lines are
never spread out. Counting a leaf's documents and tokens is a partial aggregate; lines travel as hashes, and the
text is joined once, by row. Rows are told apart by doc_id and a 64-bit hash of their text.

Edge cases: null and empty texts have no lines, as do lines of white space only, which are kept as they are and never
counted; very long texts are cut in time that grows with their length. Rows that repeat a doc_id count as one document; null doc_ids count as one more; each row loses its own
lines only. Tokens at equal count in a
place are taken by smallest token. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthloom.llm.common import stored, text_or_empty

VARIABLE = "<*>"
ROW = ["doc", "row"]


@dataclass(frozen=True)
class Params:
    depth: int = 3
    share: float = 0.5
    similar: float = 0.5
    documents: int = 3


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(token)


def _tokens(line: Column) -> Column:
    return F.array_remove(F.split(line, "[ \t\r]+"), "")


def _leaf(tokens: Column, p: Params) -> Column:
    """Hash of the path to a leaf: number of tokens and leading tokens."""
    return F.unhex(F.md5(F.concat_ws(" ", F.size(tokens).cast("string"), F.transform(F.slice(tokens, 1, p.depth), _masked))))


def leaf_lines(docs: DataFrame, p: Params) -> DataFrame:
    """doc, row, pos, tokens, leaf of the lines in leaves of enough documents.

    Only hashes of lines are shuffled to find them; the texts are joined once, by row, to the places found.
    """
    spread = docs.select(*ROW, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    cut = spread.select(*ROW, "pos", _tokens(F.col("line")).alias("tokens")).where(F.size("tokens") > 0)
    keyed = stored(cut.select(*ROW, "pos", _leaf(F.col("tokens"), p).alias("leaf")), "line-leaves")
    shared = keyed.select("leaf", "doc").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= p.documents).select("leaf")
    places = stored(keyed.join(shared, "leaf", "left_semi"), "shared-lines").groupBy(*ROW).agg(F.collect_set(F.struct("pos", "leaf")).alias("places"))
    found = docs.join(places.hint("merge"), ROW).withColumn("lines", F.split("text", "\n")).select(*ROW, "lines", F.explode("places").alias("at"))
    return found.select(*ROW, F.col("at.pos").alias("pos"), _tokens(F.get("lines", F.col("at.pos"))).alias("tokens"), F.col("at.leaf").alias("leaf"))


def templates(docs: DataFrame, p: Params) -> DataFrame:
    """doc, row, pos, template (a hash) of the lines in leaves of enough documents."""
    mine = stored(leaf_lines(docs, p), "leaf-lines")
    token = mine.select("leaf", F.posexplode("tokens").alias("at", "token")).groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("n"))
    best = token.groupBy("leaf", "at").agg(F.min_by("token", F.struct(-F.col("n"), F.col("token"))).alias("token"), F.max("n").alias("n"), F.sum("n").alias("all"))
    constant = F.when(F.col("n") >= F.col("all") * p.share, F.col("token"))
    fixed = best.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", constant.alias("token")))), lambda x: x["token"]).alias("fixed"))
    same = F.size(F.filter(F.zip_with("tokens", "fixed", lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x))
    of_leaf = F.concat_ws(" ", F.transform("fixed", lambda x: F.coalesce(x, F.lit(VARIABLE))))
    own = F.concat_ws(" ", F.transform("tokens", _masked))
    said = F.when(same >= F.size("tokens") * p.similar, of_leaf).otherwise(own)
    return mine.join(fixed, "leaf").select(*ROW, "pos", F.unhex(F.md5(said)).alias("template"))


def remove(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_lines (with tokens), n_dropped, kept_sha256 (kept lines joined by line feeds)."""
    base = docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), text_or_empty().alias("text")).withColumn("row", F.xxhash64("text"))
    named = stored(templates(base, p), "templates")
    often = named.select("template", "doc").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= p.documents).select("template")
    gone = named.join(often, "template", "left_semi").groupBy(*ROW).agg(F.collect_set("pos").alias("gone"))
    cut = F.split("text", "\n")
    gone_in_order = F.array_sort("gone")
    edges = (F.concat(F.array(F.lit(-1)), gone_in_order), F.concat(gone_in_order, F.array(F.size(cut))))
    kept = F.flatten(F.zip_with(*edges, lambda a, b: F.slice(cut, a + 2, b - a - 1)))  # the lines between those that go
    filled = F.size(F.filter(cut, lambda line: line.rlike("[^ \t\r]")))
    joined = base.join(gone.hint("merge"), ROW, "left")
    return joined.select(
        "doc_id",
        filled.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.sha2(F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")), 256).alias("kept_sha256"),
    )
