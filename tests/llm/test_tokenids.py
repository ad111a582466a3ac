from __future__ import annotations

import zlib

import numpy as np
import pytest

from depthloom.llm import files, tokenids
from depthloom.llm.perfecthash import PerfectHash
from depthloom.llm.queries import tokenizer_path


def brute(rows):
    from tokenizers import Tokenizer

    tool, out, start = Tokenizer.from_file(tokenizer_path()), [], 0
    for doc_id, text in rows:
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def params(**more):
    return tokenids.Params(tokenizer_path(), **more)


def test_whole_texts(docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(map(tuple, tokenids.digest(docs, params(shard_bytes=20_000)).collect())) == brute(rows)


def test_driver_table(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in d.collect())
    assert sorted(map(tuple, tokenids.digest(d, params()).collect())) == brute(rows)


def test_null_and_repeated_ids(odd):
    """Null ids come first, equal ids stand together, every row is written once."""
    got = sorted(map(tuple, tokenids.digest(odd, params()).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 7, 7, 7, 8, 9]
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]
    alone = {}
    for r in odd.collect():
        alone.setdefault(r.doc_id, []).append(brute([(r.doc_id, r.text)])[0][2:])
    for doc_id, made in alone.items():
        assert sorted(made) == sorted(r[2:] for r in got if r[0] == doc_id)


def test_keyed_access(spark, docs):
    data = tokenids.write(docs, params(keys_a_bucket=7, shard_bytes=20_000))
    asked = spark.createDataFrame([(5,), (-1,), (10**12,), (None,), (59,)], "doc_id long")
    found = {r.doc_id: r for r in tokenids.locate(asked, data).collect()}
    assert set(found) == {5, 59}
    r = found[59]
    with files.open_random(f"{data.path}/shard-{r.shard:06d}.bin") as source:
        ids = np.frombuffer(source.read_at(r.n_tokens * data.width, r.offset * data.width), "<u2")
    assert ids[-1] == 2 and zlib.crc32(ids.astype("<u4").tobytes()) == tokenids.read(tokenids.locate(asked.where("doc_id = 59"), data), data).first().ids_crc32
    again = tokenids.open_dataset(spark, data.path, data.entries)
    assert (again.bases == data.bases).all() and (again.shards == data.shards).all() and again.n_buckets == data.n_buckets


def test_empty_table(empty):
    assert tokenids.digest(empty, params()).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_tokenizer_gets_whole_texts(spark, docs, name):
    """Also one for which spaces count, so that cut texts would give other ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    tool, end = Tokenizer.from_file(path), 2
    said = [(1, "two  spaces and\n\nlines "), (2, "It's Ééà don't  ,\t\n STRASSE"), (3, " "), (4, "")] + [(10 + r.doc_id, r.text) for r in docs.where("doc_id > 10").collect()]
    got = {r.doc_id: r for r in tokenids.digest(spark.createDataFrame(said, "doc_id long, text string"), tokenids.Params(path, end)).collect()}
    for doc_id, text in said:
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, end]
        assert (got[doc_id].n_tokens, got[doc_id].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    index, columns = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes(x=np.arange(n)))
    assert sorted(index.lookup(keys)) == list(range(n)) and (columns["x"] == np.arange(n)).all()
    strange = np.random.default_rng(99).integers(2**63, 2**64 - 1, 1000, np.uint64)
    assert (index.lookup(strange) == -1).mean() > 0.99


def test_perfect_hash_refuses_repeated_keys():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([5, 5], np.uint64))


def test_skipped_steps_change_no_ids():
    """Texts skip the steps of the known file that cannot change them; the ids stay those of the file's own tokenizer."""
    import unicodedata

    import public_tokenizers
    from tokenizers import Tokenizer

    tool, own = tokenids.Encoder(tokenizer_path(), 2), Tokenizer.from_file(tokenizer_path())
    assert [tool.kind(t) for t in ("e\u0301", "\u00e9", "a\x1cb", "It's\t2 LINES\n", "")] == [0, 1, 1, 2, 2]
    rng = np.random.default_rng(7)
    parts = [*"abSsTtRrEeVvLlMmDd  \t\n\r'''019.,-!_", "<|endoftext|>", "<|ENDOFTEXT|>", "\x00", "\x1c", "\x7f", "\x85", "\u2003", "\u2000", "\u0130", "\u00df", "\u03a3", "\u212a", "e\u0301", "\u0301", "\u0323", "\uac00", "\u1100", "\u1161", "\u00b2", "\u0663"]
    texts = ["".join(parts[i] for i in rng.integers(0, high, 25)) for high in (len(parts), 38, 38, 39) for _ in range(3_000)]
    points = [chr(c) for c in range(0x30000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
    texts += [f"a{c}'{c}s {c}1{c}" for c in points[:20_000:2]] + ["".join(points[i : i + 30]) for i in range(0, len(points), 30)]
    assert {tool.kind(t) for t in texts} == {0, 1, 2}
    assert tool.encode(texts) == [np.array([*e.ids, 2], "<u2").tobytes() for e in own.encode_batch(texts, add_special_tokens=False)]
    other = tokenids.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert len(other.kinds) == 1 and {other.kind(t) for t in texts} == {0}


def test_whole_text_is_one_sequence():
    """The library merges a whole text at once, with ends of words as characters; no merge goes past them."""
    from tokenizers import Tokenizer

    tool, own = tokenids.Encoder(tokenizer_path(), 2), Tokenizer.from_file(tokenizer_path())
    last = lambda c: chr(ord(c) + 0x200)
    assert tool.words.marked(["It's 2 CATS", "", "x'Re'llx ''s"], True) == ["i" + last("t") + "'" + last("s") + last("2") + "cat" + last("s"), "", f"{last('x')}'r{last('e')}'l{last('l')}{last('x')}'{last(chr(39))}{last('s')}"]
    assert tool.words.marked(["İ", "É 1"], False) == [None, "Ã" + last("©") + last("1")]
    assert [tool.kind(t) for t in ("a <|endoftext|>", "a <|ENDOFTEXT|>")] == [0, 2]
    texts = ["th e the\nthe the", " ", "'s'S 'sx 'll'l ''re're '", "a" * 70_000, "İ is 1", "x <|endoftext|> y", "x <|EndOfText|> y", "中文 \U0001f600\U0001f600! \U0001d7d8٣", "ΟΣ ΟΣΑ", "\x00\x1f \x7f'"]
    texts += ["It's the café's; he'll 've 12 %%% " * 20_000]
    assert tool.encode(texts) == [np.array([*own.encode(t, add_special_tokens=False).ids, 2], "<u2").tobytes() for t in texts]
    assert all(len(t.encode(tool.words.marked([texts[-1]], False)[0]).ids) == len(own.encode(texts[-1]).ids) for t in tool.kinds[1:])
