"""Near-duplicates: MinHash with banding, signature verification, confirmation on full sets,
components by large-star and small-star.

A document's set is its distinct ``shingle``-word shingles (the whole word sequence, if it is shorter), as 64-bit
hashes; the signature is the minima of ``bands * rows`` universal hashes. Documents of equal sets are one node.
Two nodes that share all minima of a band meet in that band's bucket; at a similarity of 0.75, 32 bands of 4
miss a pair with probability 5e-6.

Pairs are not made within a bucket. In each of ``rounds`` rounds every bucket has a centre (first the member
that meets most others, then a random one), and its members are compared with the centre alone: a pair must
agree in enough minima (six standard deviations below the expected number at the threshold), then in the full sets
of its texts. What buckets still hold in different components is looked at again by prefixes: two sets alike at the
threshold share one of the ``n - ceil(threshold * n) + 1`` rarest shingles of each, in one order for all (shingles of
one component, then by exact counts and hash), so texts that meet in buckets through common passages alone part here, whatever their number.
Texts of different components that share such a shingle form clusters, which are compared in blocks, by products of
shingle incidence matrices over the full sets, which give out a spanning forest only: every pair of a bucket
that could still join two components is compared, and the links returned stay below the number of documents.

Edge cases: a very long text is shingled whole, in a slice of its own. Documents without words are linked with nothing, have a set size of 0 and stay. In ``groups`` null doc_ids take
no part: component null, kept. In ``deduplicate`` a set that only rows without a doc_id have is a node of its own, above
2**62, so that a copy of a document with an id goes and one row of a group without ids stays. Rows that repeat a doc_id are one document, so its texts are linked; those of them with words
share its fate. Ties of components go to the smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthloom.llm import textkernel as K
from depthloom.llm.common import stored, text_or_empty
from depthloom.llm.components import components

_SALT = np.uint64(0x7F4A7C159E3779B9)
_NO_ID = 2**62


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    rounds: int = 2
    block_rows: int = 512
    block_bytes: int = 4_000_000
    seed: int = 5

    def prefix(self, n: np.ndarray | Column) -> np.ndarray | Column:
        """How many of n shingles must hold a common one with every set that is alike."""
        share = self.percent * n
        return n - (share + (100 - share % 100) % 100) / 100 + 1

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def agreeing(self) -> int:
        share = self.percent / 100
        return int(max(0, self.hashes * share - 6 * (self.hashes * share * (1 - share)) ** 0.5))


def shingles(buf: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every shingle in row order; repeats are left in."""
    low = K.lower_ascii()[buf]
    starts, ends, ptr = K.word_spans(low, offsets, K.ascii_space())
    words, lengths = K.word_hashes(low, starts, ends), np.diff(ptr)
    whole = K.inside(ptr, size, len(words))
    grams = K.gram_hashes(words, size)[whole]
    row = np.repeat(np.arange(len(lengths)), np.maximum(lengths - size + 1, 0))
    for n in range(1, size):
        short = np.flatnonzero(lengths == n)
        if len(short):
            grams = np.concatenate([grams, K.gram_hashes(words, n)[ptr[short]]])
            row = np.concatenate([row, short])
    order = np.argsort(row, kind="stable") if len(row) and (np.diff(row) < 0).any() else slice(None)
    return grams[order], row[order]


def _first_of_row(grams: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Mask that leaves one of each row's equal hashes."""
    order = np.lexsort((grams, row))
    g, r = grams[order], row[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    out = np.empty(len(g), bool)
    out[order] = first
    return out


def _set_hashes(grams: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set size, k1 and k2 of each row, rows with a set, start of each of these in ``grams``), given distinct shingles."""
    n, k1, k2 = np.bincount(row, minlength=rows), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    full = np.flatnonzero(n)
    at = (np.cumsum(n) - n)[full]
    if len(full):
        k1[full] = np.add.reduceat(K.mix(grams), at)
        k2[full] = np.add.reduceat(K.mix(grams ^ _SALT), at)
    return n, k1, k2, full, at


def signatures(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, n (set size), k1 and k2 (hash of the set), sig (minima, little-endian 32-bit)."""
    rng = np.random.default_rng(p.seed)
    a = rng.integers(0, 2**63, p.hashes, np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, p.hashes, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in K.slices(batch.column("text")):
                grams, row = shingles(buf, offsets, p.shingle)
                once = _first_of_row(grams, row)
                grams, row = grams[once], row[once]
                n, k1, k2, full, at = _set_hashes(grams, row, end - first)
                sig = np.zeros((end - first, p.hashes), np.uint32)
                if len(grams):
                    scaled = np.empty_like(grams)
                    for i in range(p.hashes):
                        np.multiply(grams, a[i], out=scaled)
                        np.add(scaled, b[i], out=scaled)
                        sig[full, i] = np.minimum.reduceat(scaled, at) >> np.uint64(32)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, end - first), pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array([x.tobytes() for x in sig], pa.binary())],
                    names=["doc_id", "n", "k1", "k2", "sig"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n long, k1 long, k2 long, sig binary")


def rows_without_id(docs: DataFrame, p: Params) -> DataFrame:
    """row (all columns, as c0, c1, ...), text, n, k1, k2 of the rows without a doc_id."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    columns = docs.toDF(*own)
    at = {name: own[i] for i, name in enumerate(docs.columns)}
    bare = columns.where(F.col(at["doc_id"]).isNull()).select(F.struct(*own).alias("row"), text_or_empty(at["text"]).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in K.slices(batch.column("text")):
                grams, row = shingles(buf, offsets, p.shingle)
                once = _first_of_row(grams, row)
                n, k1, k2, _, _ = _set_hashes(grams[once], row[once], end - first)
                part = batch.slice(first, end - first)
                yield pa.record_batch([*part.columns, pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))], names=["row", "text", "n", "k1", "k2"])

    schema = T.StructType([*bare.schema.fields, *(T.StructField(c, T.LongType()) for c in ("n", "k1", "k2"))])
    return bare.mapInArrow(run, schema)


def _agreeing(pairs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """Signature verification of pairs (a, b)."""
    sig = nodes.select("node", "n", "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, p.hashes) for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).filter(pa.array((left == right).sum(1) >= p.agreeing))

    both = pairs.join(sig.toDF("a", "n_a", "sig_a"), "a").join(sig.toDF("b", "n_b", "sig_b"), "b")
    return both.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * p.percent).select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity, as links (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                sets = []
                for c in ("text_a", "text_b"):
                    _, _, buf, offsets = next(K.slices(batch.column(c), 2**62))
                    grams, row = shingles(buf, offsets, p.shingle)
                    once = _first_of_row(grams, row)
                    grams, row = grams[once], row[once]
                    sets.append((K.mix(grams + (row.astype(np.uint64) + np.uint64(1)) * _SALT), row))
                (left, rows), (right, other) = sets
                size = batch.num_rows
                common = np.bincount(rows[np.isin(left, right)], minlength=size)
                union = np.bincount(rows, minlength=size) + np.bincount(other, minlength=size) - common
                ok = (100 * common >= p.percent * union) & (union > 0)
                yield pa.record_batch([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(ok))

    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "u long, v long").distinct()


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _repeated(named: DataFrame) -> DataFrame:
    """Links between the nodes of rows that repeat a doc_id."""
    own = named.where("node is not null and doc_id is not null").select("doc_id", "node")
    several = own.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("top")).where("u <> top").select("doc_id", "u")
    return own.join(several, "doc_id").select("u", F.col("node").alias("v"))


def _forest(batch: pa.Table, p: Params) -> pa.Table:
    """Compares all texts of a block pair by products of their shingle incidence matrix; links of a spanning forest
    between the components that were not joined before."""
    node = np.asarray(batch.column("node").combine_chunks())
    _, mark = np.unique(np.asarray(batch.column("component").combine_chunks()), return_inverse=True)
    u, v = [], []
    if mark.max() > 0:
        _, _, buf, offsets = next(K.slices(batch.column("text").combine_chunks(), 2**62))
        grams, row = shingles(buf, offsets, p.shingle)
        once = _first_of_row(grams, row)
        grams, row = grams[once], row[once]
        size = np.bincount(row, minlength=len(node))
        _, name, times = np.unique(grams, return_inverse=True, return_counts=True)
        shared = times[name] > 1
        _, name = np.unique(name[shared], return_inverse=True)
        row = row[shared]
        order = np.argsort(name, kind="stable")
        name, row = name[order], row[order]
        common = np.zeros((len(node), len(node)), np.float32)
        for low in range(0, int(name.max()) + 1 if len(name) else 0, 4096):
            i, j = np.searchsorted(name, [low, low + 4096])
            part = np.zeros((len(node), 4096), np.float32)
            part[row[i:j], name[i:j] - low] = 1
            common += part @ part.T
        linked = (100 * common >= p.percent * (size[:, None] + size[None, :] - common)) & (size > 0)[:, None]
        for i in range(len(node)):
            near = np.flatnonzero(linked[i] & (mark != mark[i]))
            for j in near:
                if mark[j] != mark[i]:
                    u.append(node[i])
                    v.append(node[j])
                    mark[mark == mark[j]] = mark[i]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _distinct(column: pa.Array, p: Params) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, shingles, row of each) by slice, each shingle of a row once."""
    for first, end, buf, offsets in K.slices(column):
        grams, row = shingles(buf, offsets, p.shingle)
        once = _first_of_row(grams, row)
        yield first, end, grams[once], row[once]


def _prefixes(texts: DataFrame, p: Params) -> DataFrame:
    """node, component, gram: the shingles of each text's prefix that texts of several components hold.

    The order is that of exact counts at every size: shingles of one component come first, as they can join nothing,
    then the others by the number of texts that hold them. Only the latter are ranked; the former are told by their number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, grams, row in _distinct(batch.column("text"), p):
                at, n = pa.array(first + row), np.bincount(row, minlength=end - first)
                yield pa.record_batch([batch.column("node").take(at), batch.column("component").take(at), pa.array(n[row]), pa.array(grams.view(np.int64))], names=["node", "component", "n", "gram"])

    held = stored(texts.select("node", "component", "text").mapInArrow(run, "node long, component long, n long, gram long"), "shingles")
    spread = held.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("times"))
    common = stored(spread.where("x <> y").select("gram", "times"), "common-shingles")
    of_node = Window.partitionBy("node")
    ranked = held.select("gram", "node", "n").join(common, "gram").select("*", F.count(F.lit(1)).over(of_node).alias("held"), F.row_number().over(of_node.orderBy("times", "gram")).alias("rank"))
    chosen = ranked.where(F.col("rank") <= p.prefix(F.col("n")) - (F.col("n") - F.col("held"))).select("node", "gram")
    return chosen.join(texts.select("node", "component"), "node").select("node", "component", "gram")


def _clusters(texts: DataFrame, p: Params) -> DataFrame:
    """node, component, cluster of the texts that share a prefix shingle with one of another component."""
    held = stored(_prefixes(texts, p), "prefixes")
    mixed = held.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("node").alias("v")).where("x <> y").select("gram", "v")
    edges = stored(held.join(mixed, "gram").select(F.col("node").alias("u"), "v", "component").distinct(), "prefix-links")
    return edges.select(F.col("u").alias("node"), "component").distinct().join(components(edges.select("u", "v")).withColumnRenamed("component", "cluster"), "node")


def _blocks(rows: DataFrame, p: Params) -> DataFrame:
    """Adds block to the rows of clusters (cluster, node, component, size), and pure: the component that fills the block, if one does.

    A component of half a block or more has blocks of its own, by hash of its nodes; smaller ones are pooled whole, by hash of
    the component. A block has about ``block_rows`` rows and ``block_bytes`` bytes.
    """

    def share(n: str, size: str) -> Column:
        return F.greatest(F.col(n) / p.block_rows, F.col(size) / p.block_bytes)

    parts = rows.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    parts = parts.withColumn("share", share("n", "size")).withColumn("own", F.col("share") >= 0.5)
    pool = parts.groupBy("cluster").agg(F.ceil(F.greatest(F.sum(F.when(~F.col("own"), F.col("share"))), F.lit(1.0))).cast("int").alias("pool"))
    dealt = rows.join(parts.select("cluster", "component", "own", F.ceil("share").cast("int").alias("parts")).join(pool, "cluster"), ["cluster", "component"])
    name = F.when(F.col("own"), F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("parts")))).otherwise(F.pmod(F.xxhash64("component"), F.col("pool")))
    return dealt.withColumns({"block": name.cast("long"), "pure": F.when(F.col("own"), F.col("component"))}).drop("own", "parts", "pool")


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """cluster, i, j: pairs of blocks of a cluster, a block with itself too, but none that holds one component only."""
    left, right = blocks.toDF("cluster", "i", "x"), blocks.toDF("cluster", "j", "y")
    return left.join(right, "cluster").where("i <= j and not coalesce(x = y, false)").select("cluster", "i", "j")


def _within_clusters(members: DataFrame, texts: DataFrame, found: DataFrame, p: Params) -> DataFrame:
    """Links between different components among documents that buckets of several components hold together.

    Their clusters (by prefixes) are cut into blocks by component and by hash, and every pair of blocks that can hold two
    components is one group: no group grows with its cluster, and what is joined already is not compared with itself.
    """
    own = members.join(found, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = own.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    open_ = stored(own.join(mixed, "bucket").select("node", "component").distinct().join(texts, "node"), "open-texts")
    rows = stored(_blocks(_clusters(open_, p).join(open_.select("node", F.octet_length("text").alias("size")), "node"), p), "cluster-blocks")
    pairs = stored(_block_pairs(rows.select("cluster", "block", "pure").distinct()), "block-pairs")
    sides = pairs.withColumn("block", F.col("i")).union(pairs.where("i <> j").withColumn("block", F.col("j")))
    keyed = rows.join(sides, ["cluster", "block"]).join(open_.select("node", "text"), "node").select("cluster", "i", "j", "node", "component", "text")
    return keyed.groupBy("cluster", "i", "j").applyInArrow(lambda t: _forest(t, p), "u long, v long")


def link(docs: DataFrame, p: Params = Params(), bare: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(signature table with the node of each document, (node, component) of linked nodes).

    Rows without a doc_id take part if they are given as ``bare``.
    """
    base = stored(signatures(docs, p), "signatures")
    takes_part = (F.col("n") > 0) & (F.col("doc_id").isNotNull() if bare is None else F.lit(True))
    node = F.min("doc_id") if bare is None else F.coalesce(F.min("doc_id"), F.col("k1").bitwiseAND(_NO_ID - 1).bitwiseOR(_NO_ID))
    nodes = stored(
        base.where(takes_part).groupBy("k1", "k2").agg(node.alias("node"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig")), "nodes"
    )
    named = base.select("doc_id", "n", "k1", "k2").join(nodes.select("k1", "k2", "node"), ["k1", "k2"], "left").select("doc_id", "n", "k1", "k2", F.when(takes_part, F.col("node")).alias("node"))
    width = 4 * p.rows
    buckets = nodes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(p.bands - 1)), lambda i: F.xxhash64(i, F.substring("sig", i * width + 1, F.lit(width))))).alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(buckets.join(shared.select("bucket"), "bucket", "left_semi"), "members")
    meeting = members.select("node").distinct()
    told = docs.select(F.col("doc_id").cast("long").alias("node"), text_or_empty().alias("text"))
    if bare is not None:
        alone = named.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.any_value("node").alias("node")).where("first is null").select("k1", "k2", "node")
        told = told.union(bare.join(alone, ["k1", "k2"]).groupBy("node").agg(F.min("text").alias("text")))
    texts = stored(told.join(meeting, "node", "left_semi"), "member-texts")
    met = stored(nodes.select("node", "n", "sig").join(meeting, "node", "left_semi"), "member-signatures")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    crowd = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("crowd"))
    ranked = stored(members.join(crowd, "node"), "ranked-members")
    links, found = _repeated(named), None
    for turn in range(p.rounds):
        own = ranked if found is None else ranked.join(found, "node", "left")
        own = own.withColumn("component", F.col("node") if found is None else F.coalesce("component", "node"))
        first = F.struct(F.xxhash64("node", F.lit(turn)) if turn else -F.col("crowd"), F.col("node"))
        centre = own.groupBy("bucket").agg(F.min_by(F.struct(F.col("node").alias("c"), F.col("component").alias("cc")), first).alias("m")).select("bucket", "m.*")
        pairs = stored(_ordered(own.join(centre, "bucket").where("component <> cc"), "node", "c"), "pairs")
        new = stored(_confirmed(_agreeing(pairs, met, p), texts, p), "confirmed")
        found = stored(components(links.union(new)), "components")
        links = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
    new = stored(_within_clusters(members, texts, found, p), "cluster-links")
    if not new.isEmpty():
        found = stored(components(links.union(new)), "components")
    return named, found


def groups(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row a document."""
    named, found = link(docs, p)
    return (
        named.join(found, "node", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    )


def deduplicate(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The documents of smallest doc_id of each group, with their columns; of a group without doc_ids one row."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    at = {name: own[i] for i, name in enumerate(docs.columns)}
    rows, told = docs.toDF(*own), docs.select("doc_id", "text")
    bare = stored(rows_without_id(docs, p), "rows-without-id")
    if bare.isEmpty():
        gone = groups(told, p).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
        return rows.join(gone, F.col(at["doc_id"]) == F.col("gone"), "left_anti").toDF(*docs.columns)
    named, found = link(told, p, bare)
    named = stored(named.join(found, "node", "left").withColumn("component", F.coalesce("component", "node", "doc_id")), "named")
    gone = named.where("doc_id <> component").select(F.col("doc_id").alias("gone")).distinct()
    kept = rows.where(F.col(at["doc_id"]).isNotNull()).join(gone, F.col(at["doc_id"]) == F.col("gone"), "left_anti")
    alone = named.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.any_value("node").alias("node"), F.any_value("component").alias("component"))
    roots = alone.where("first is null and node = component").select("k1", "k2")
    one = bare.where("n > 0").join(roots, ["k1", "k2"]).groupBy("k1", "k2").agg(F.min_by("row", F.struct("text", F.xxhash64("row"))).alias("row"))
    return kept.union(one.select("row.*")).union(bare.where("n = 0").select("row.*")).toDF(*docs.columns)
