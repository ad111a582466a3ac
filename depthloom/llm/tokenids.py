"""Token-ID shards with a minimal perfect hash index.

``write`` deals the documents by ascending doc_id into shards, encodes each whole text with a
tokenizers file, appends the end id and writes the ids back to back, little-endian, two bytes an
id for a vocabulary of at most 65,536, else four. Entries of all documents are hashed by doc_id into
buckets of bounded size; each bucket's index file holds a minimal perfect hash with fingerprints and,
by slot, the key, shard, offset and length. ``locate`` finds documents in constant time from
those files, ``read`` their ids.

Every text goes to the library whole, whatever tokenizer the file holds; nothing is cut, remembered or taken past its
merges. For files with the known steps (``_STEPS``) and a vocabulary that marks the ends of words, a text that is composed
already is lower-cased and cut into words by numpy (``Words``), and the library merges the whole text as one sequence: a last
character is a character of its own, and no merge leads from it to the next word. Other texts take the file's tokenizer.

Edge cases: a null or empty text is the end id alone. Null doc_ids come first. Rows that repeat a
doc_id are ordered by a hash of the text and are all written; the index leads to the first of them, and null
doc_ids are not indexed: ``read_documents`` reads both by their stored place. An empty table gives no
shards. Shard boundaries follow a sample; contents and order do not depend on them. The driver holds two
numbers a shard of ``shard_bytes`` of text. A very long text is encoded whole too, alone in its batch; a worker holds about
``BATCH_BYTES`` of text or one text, its ids, and for each of its characters the arrays of ``Words`` and the library's symbols.
"""

from __future__ import annotations

import functools
import json
import math
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom.llm import files
from depthloom.llm.common import fresh_dir, stored, text_or_empty
from depthloom.llm.perfecthash import PerfectHash
from depthloom.llm.textkernel import mix, slices

BATCH_BYTES = 150_000
READ_BYTES = 8_000_000

#: The steps before the model that ``Words`` takes.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Of the model: what must hold besides for a text to be one sequence.
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
_LETTER, _NUMBER, _OTHER, _SPACE, _MANY, _NEW = range(6)
#: Added to the last character of a word; the byte characters end below.
_LAST = 0x200
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]").search


@dataclass(frozen=True)
class Params:
    tokenizer: str
    end_id: int = 2
    shard_bytes: int = 128_000_000
    keys_a_bucket: int = 16_384


class Words:
    """The known steps up to the model, over many texts at once: lower case, split, byte characters, ends of words.

    What a code point is, and its lower case, is asked of the library once.
    """

    def __init__(self) -> None:
        from tokenizers import Regex, normalizers, pre_tokenizers

        said = _STEPS["pre_tokenizer"]["pretokenizers"][0]
        self.split = pre_tokenizers.Split(Regex(said["pattern"]["Regex"]), "removed", invert=True)
        self.lowercase = normalizers.Lowercase()
        self.kinds = np.full(0x110000, _NEW, np.uint8)
        self.lower = np.zeros(0x110000, np.uint32)
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.characters = np.zeros(256, np.uint16)
        for c in map(chr, (*range(0x801), *range(0x1000, 0xD800, 0x1000), *range(0xE000, 0x110000, 0x1000))):  # every byte that UTF-8 has
            self.characters[list(c.encode())] = [ord(x) for x in in_bytes.pre_tokenize_str(c)[0][0]]

    def _learn(self, points: np.ndarray) -> None:
        for point in points.tolist():
            low = self.lowercase.normalize_str(chr(point))
            if len(low) != 1:
                self.kinds[point] = _MANY
                continue
            parts = [part for part, _ in self.split.pre_tokenize_str(f"{low}{low}a")]
            self.kinds[point] = {1: _LETTER if len(parts[0]) == 3 else _SPACE, 2: _OTHER, 3: _NUMBER}[len(parts)]
            self.lower[point] = ord(low)

    def marked(self, texts: list[str], in_ascii: bool) -> list[str | None]:
        """Each text's byte characters without white space, the last one of a word raised by ``_LAST``; None if a
        character has a longer lower case."""
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("ascii"), np.uint8) if in_ascii else np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kinds = self.kinds[points]
        if (kinds == _NEW).any():
            self._learn(np.unique(points[kinds == _NEW]))
            kinds = self.kinds[points]
        low, n = np.append(self.lower[points], np.zeros(2, np.uint32)), len(points)
        starts = np.ones(n + 1, bool)
        starts[1:n] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _NUMBER)
        quotes = np.flatnonzero(low == ord("'"))
        quotes = quotes[(quotes == 0) | (kinds[quotes - 1] != _OTHER)]
        one, two = low[quotes + 1], low[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        starts[quotes[short | long] + 1] = False
        starts[quotes[short] + 2] = True
        starts[quotes[long] + 3] = True

        keep = kinds != _SPACE
        kept, last = low[:n][keep], starts[1:][keep]
        raw = np.frombuffer(kept.astype(np.uint8) if in_ascii else kept.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        ends = np.arange(len(raw)) if in_ascii else np.flatnonzero(np.append((raw[1:] & 0xC0) != 0x80, len(raw) > 0))
        made = self.characters[raw]
        made[ends[last]] += _LAST
        whole = made.astype("<u2").tobytes().decode("utf-16-le")
        text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        after = np.append(0, ends + 1)[np.append(0, np.cumsum(keep))[text_ends]].tolist()
        out = [whole[i:j] for i, j in zip([0, *after], after, strict=False)]
        for i in np.searchsorted(text_ends, np.flatnonzero(kinds == _MANY)).tolist():
            out[i] = None
        return out


class Encoder:
    """Encodes whole texts to the bytes of their ids."""

    def __init__(self, path: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 65_536 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.kinds, self.added = [self.tokenizer], []
        merging = self._of_whole_texts()
        if merging:
            self.kinds += [merging, merging]
            self.words = Words()

    def _of_whole_texts(self):
        """The file's merges for a whole text as one sequence, ends of words as characters; None if the file does not allow it."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        said = json.loads(self.tokenizer.to_str())
        model, end = said["model"], _MODEL["end_of_word_suffix"]
        if any(said[k] != v for k, v in _STEPS.items()) or any(model.get(k) != v for k, v in _MODEL.items()) or any(t["normalized"] for t in said["added_tokens"]):
            return None

        def renamed(token: str) -> str:
            return token[: -len(end) - 1] + chr(ord(token[-len(end) - 1]) + _LAST) if token.endswith(end) else token

        if any(end in w.removesuffix(end) or w == end for w in model["vocab"]):
            return None
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        vocab = {renamed(w): i for w, i in model["vocab"].items()}
        merges = [(renamed(a), renamed(b)) for a, b in model["merges"]]
        known = alphabet | {chr(ord(c) + _LAST) for c in alphabet}
        if not known <= vocab.keys() or not set().union(*vocab) <= known or any(ord(a[-1]) >= _LAST or a + b not in vocab for a, b in merges):
            return None
        self.added = [t["content"] for t in said["added_tokens"]]
        return Tokenizer(models.BPE(vocab=vocab, merges=merges, cache_capacity=0))

    def kind(self, text: str) -> int:
        """How the text is taken: 0 by the file's tokenizer, 1 as composed, 2 as printable ASCII text."""
        if len(self.kinds) == 1 or any(t in text for t in self.added):
            return 0
        if text.isascii():
            return 1 if _CONTROL(text) else 2
        return 1 if unicodedata.is_normalized("NFC", text) else 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end id, as bytes."""
        code, end, out = self.dtype.char, self.end, [b""] * len(texts)
        taken: dict[int, list[tuple[int, str]]] = {0: [], 1: [], 2: []}
        for i, text in enumerate(texts):
            taken[self.kind(text)].append((i, text))
        for k in (2, 1):
            if taken[k]:
                ready = self.words.marked([text for _, text in taken[k]], k == 2)
                taken[0] += [one for one, marked in zip(taken[k], ready, strict=True) if marked is None]
                taken[k] = [(i, marked) for (i, _), marked in zip(taken[k], ready, strict=True) if marked is not None]
        for k, mine in taken.items():
            if mine:
                made = self.kinds[k].encode_batch_fast([text for _, text in mine], add_special_tokens=False)
                for (i, _), e in zip(mine, made, strict=True):
                    out[i] = array(code, e.ids).tobytes() + end
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    """One a worker process, which runs many tasks."""
    return Encoder(path, end_id)


@dataclass(frozen=True)
class Dataset:
    """A written data set. shards: numbers of its files, ascending; bases: ids before each; entries: a row a document."""

    path: str
    width: int
    n_buckets: int
    shards: np.ndarray
    bases: np.ndarray
    entries: DataFrame


def _shard(path: str, number: int) -> str:
    return f"{path}/shard-{number:06d}.bin"


def _bucket(path: str, number: int) -> str:
    return f"{path}/index-{number:06d}.mph"


def _hash(ids: np.ndarray) -> np.ndarray:
    return mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x51ED270B))


def write(docs: DataFrame, p: Params, path: str | None = None) -> Dataset:
    """Writes shards, index and manifest below ``path``, by default a new shared folder."""
    spark = docs.sparkSession
    path = path or fresh_dir(spark, "token-ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / p.shard_bytes), min(spark.sparkContext.defaultParallelism, math.ceil(total / 1_000_000)))
    tie = F.xxhash64("text").alias("_tie")
    dealt = rows.select("doc_id", "text", tie).repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "_tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, tool, draft, at = TaskContext.get().partitionId(), encoder(p.tokenizer, p.end_id), None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            draft = draft or files.Draft(_shard(path, number))
            lengths = np.zeros(batch.num_rows, np.int64)
            for first, end, _, _ in slices(batch.column("text"), BATCH_BYTES):
                made = tool.encode(batch.column("text").slice(first, end - first).to_pylist())
                draft.write(b"".join(made))
                lengths[first:end] = [len(x) // tool.dtype.itemsize for x in made]
            ends = at + np.cumsum(lengths)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.full(batch.num_rows, number, np.int32)), pa.array(ends - lengths), pa.array(lengths)],
                names=["doc_id", "shard", "offset", "n_tokens"],
            )
            at = int(ends[-1])
        if draft:
            draft.close()

    entries = stored(dealt.select("doc_id", "text").mapInArrow(encode, "doc_id long, shard int, offset long, n_tokens long"), "token-entries")
    sums = entries.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").toPandas()  # two numbers a shard
    numbers, sizes = sums["shard"].to_numpy(np.int64), sums["n"].to_numpy(np.int64)
    bases = np.cumsum(sizes) - sizes
    n_buckets = _index(entries, p, path)
    width = encoder(p.tokenizer, p.end_id).dtype.itemsize
    shards_said = [list(map(int, row)) for row in zip(numbers, bases, sizes, strict=True)]
    files.write_whole(f"{path}/manifest.json", json.dumps({"width": width, "buckets": n_buckets, "end_id": p.end_id, "shards": shards_said}).encode())
    return Dataset(path, width, n_buckets, numbers, bases, entries)


def _numbered(keyed: DataFrame, n_buckets: int) -> DataFrame:
    """Adds the index bucket of each doc_id."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = (_hash(np.asarray(batch.column("doc_id"))) % np.uint64(n_buckets)).astype(np.int32)
            yield batch.append_column("bucket", pa.array(bucket))

    return keyed.mapInArrow(number, f"{', '.join(f'{k} {t}' for k, t in keyed.dtypes)}, bucket int")


def _index(entries: DataFrame, p: Params, path: str) -> int:
    keyed = entries.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("shard", "offset", "n_tokens")).alias("e"))
    keyed = keyed.select("doc_id", "e.*")
    n_buckets = max(1, math.ceil(entries.count() / p.keys_a_bucket))

    def build(group: pa.Table) -> pa.Table:
        ids = np.asarray(group.column("doc_id").combine_chunks())
        index = PerfectHash.build(_hash(ids))
        order = np.empty(len(ids), np.int64)
        order[index.lookup(_hash(ids))] = np.arange(len(ids))
        columns = {c: np.asarray(group.column(c).combine_chunks())[order] for c in ("doc_id", "shard", "offset", "n_tokens")}
        bucket = group.column("bucket")[0].as_py()
        files.write_whole(_bucket(path, bucket), index.to_bytes(**columns))
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "keys": pa.array([len(ids)], pa.int64())})

    stored(_numbered(keyed, n_buckets).groupBy("bucket").applyInArrow(build, "bucket int, keys long"), "token-index")
    return n_buckets


@functools.lru_cache(maxsize=4)
def _load(uri: str) -> tuple[PerfectHash, dict[str, np.ndarray]] | None:
    try:
        return PerfectHash.from_bytes(files.read_whole(uri))
    except FileNotFoundError:
        return None


def locate(keys: DataFrame, data: Dataset) -> DataFrame:
    """doc_id, shard, offset, n_tokens of the keys (column doc_id) that the index holds."""

    data_path, n_buckets = data.path, data.n_buckets

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bucket = np.asarray(batch.column("doc_id")), np.asarray(batch.column("bucket"))
            for b in np.unique(bucket):
                index = _load(_bucket(data_path, int(b)))
                if index is None:
                    continue
                mine = ids[bucket == b]
                slot = index[0].lookup(_hash(mine))
                known = slot >= 0
                known[known] = index[1]["doc_id"][slot[known]] == mine[known]
                slot = slot[known]
                yield pa.record_batch([pa.array(mine[known]), *(pa.array(index[1][c][slot]) for c in ("shard", "offset", "n_tokens"))], names=["doc_id", "shard", "offset", "n_tokens"])

    asked = _numbered(keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null"), n_buckets)
    together = asked.repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    return together.mapInArrow(find, "doc_id long, shard int, offset long, n_tokens long")


def read(places: DataFrame, data: Dataset) -> DataFrame:
    """Adds start and ids_crc32 from the shard files to located rows; each task opens its shards
    in turn and reads neighbouring documents, which come in order, by up to ``READ_BYTES`` at once."""
    path, width = data.path, data.width
    known = places.sparkSession.sparkContext.broadcast((data.shards, data.bases))  # two numbers a shard

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, base, source = -1, 0, None
        for batch in batches:
            shard, offset, length = (np.asarray(batch.column(c)) for c in ("shard", "offset", "n_tokens"))
            start, crc = np.empty(len(shard), np.int64), np.empty(len(shard), np.int64)
            end, first = offset + length, 0
            while first < len(shard):
                if shard[first] != number:
                    number = int(shard[first])
                    base = int(known.value[1][np.searchsorted(known.value[0], number)])
                    source = files.open_random(_shard(path, number))
                far = (shard[first:] != number) | ((end[first:] - offset[first]) * width > READ_BYTES)
                stop = first + max(1, int(np.argmax(far)) if far.any() else len(far))
                low, high = int(offset[first]), int(end[first:stop].max())
                raw = np.frombuffer(source.read_at((high - low) * width, low * width), f"<u{width}")
                for i in range(first, stop):
                    ids = raw[offset[i] - low : end[i] - low]
                    start[i], crc[i] = base + int(offset[i]), zlib.crc32(ids.astype("<u4").tobytes())
                first = stop
            yield pa.record_batch([batch.column("doc_id"), pa.array(start), batch.column("n_tokens"), pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return places.select("doc_id", "shard", "offset", "n_tokens").mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(data: Dataset) -> DataFrame:
    """Every written document from the files: by the index, and by stored place for null and repeated doc_ids."""
    first = data.entries.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("shard", "offset")).alias("f"))
    found = locate(first.select("doc_id"), data)
    firsts = first.select(F.col("f.shard").alias("fs"), F.col("f.offset").alias("fo"))
    rest = data.entries.join(firsts, (F.col("shard") == F.col("fs")) & (F.col("offset") == F.col("fo")), "left_anti")
    places = found.unionByName(rest)
    return read(places.repartition(max(1, len(data.shards)), "shard").sortWithinPartitions("shard", "offset"), data)


def digest(docs: DataFrame, p: Params) -> DataFrame:
    """Writes the documents and returns doc_id, start, n_tokens and ids_crc32 as the files have them."""
    return read_documents(write(docs, p))


def open_dataset(spark: SparkSession, path: str, entries: DataFrame) -> Dataset:
    """A data set that was written before."""
    m = json.loads(files.read_whole(f"{path}/manifest.json"))
    said = np.array(m["shards"], np.int64).reshape(-1, 3)
    return Dataset(path, m["width"], m["buckets"], said[:, 0], said[:, 1], entries)
