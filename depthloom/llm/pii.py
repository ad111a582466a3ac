"""Personal data: fixed patterns, and spans that a conditional random field adds.

Base spans, leftmost and not overlapping within a kind: e-mail addresses, IPv4 addresses with parts up to
255, card numbers of 16 to 19 digits that pass Luhn's test, and international phone numbers of 8 to 15 digits.
The random field (see ``crf``) reads every word of the text and adds national phone numbers, identity numbers,
written-out e-mail addresses and secrets such as access keys; an added span that touches a base span is dropped.

The model is trained on the driver from a small table of labelled sentences, by default ``examples()``, which
builds them by rule; at most ``max_examples`` of a given table are used. Texts are not shuffled.

Spans are code points, end exclusive, by kind in the order of ``KINDS``, then start.

Edge cases: null and empty texts have no spans; very long texts are read whole, in time that grows with their length; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthloom.llm import textkernel as K
from depthloom.llm.common import text_or_empty
from depthloom.llm.crf import Crf, train

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "id", "secret")

# The patterns of the base kinds. An address starts where its digits do, so a long run is tried once.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


@dataclass(frozen=True)
class Params:
    sentences: int = 1500
    seed: int = 4
    max_examples: int = 5_000


def emails(text: str) -> list[tuple[int, int]]:
    """Every match starts at the run of local characters before its @, so only the @s are visited."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        while m and start > end and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at:
            out.append((start, m.end()))
            end = m.end()
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c in string.digits for c in m[0]) <= 15]
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), *s[1:])))


def examples(sentences: int, seed: int) -> list[tuple[list[str], list[str]]]:
    """Labelled sentences built by rule: filler with or without one item of a kind, and look-alikes that are none."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choices(string.digits, k=n))
    some = lambda letters, n: "".join(rng.choices(letters, k=n))

    common = "at at dot com of the la call id is on to was under my your for please with before after number and in from by his her it".split()

    def word() -> str:
        w = rng.choice(common) if rng.random() < 0.3 else some("etaoinshrdlucmfwypé", rng.randint(1, 12))
        return rng.choice([w, w, w, w, w.capitalize(), w.upper(), w + ",", w + ".", w + rng.choice(["!!", "%%%", "***", "|", "&&&", "@", "#", "$"])])

    def item() -> tuple[list[str], str]:
        kind = rng.choice(["phone", "id", "secret", "email", "secret"])
        if kind == "phone":
            a, b, c = digits(3), digits(3), digits(4)
            said = rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"({a}) {b} {c}", f"{a}.{b}.{c}"])
            before = rng.choice([["call"], ["phone:"], ["tel"], ["mobile:"], ["at"], []])
        elif kind == "id":
            said = rng.choice([f"{digits(3)}-{digits(2)}-{digits(4)}", some(string.ascii_uppercase, 2) + digits(7)])
            before = rng.choice([["ssn"], ["ssn:"], ["passport"], ["id"]])
        elif kind == "email":
            said = rng.choice(["{} [at] {} [dot] com", "{} (at) {} (dot) org", "{}[at]{}[dot]com"]).format(some("abcdefghij", 5) + rng.choice(["", ".", "_"]) + some("klmno", 4), some("pqrstu", 6))
            before = rng.choice([["mail"], ["write"], ["email:"], ["contact"]])
        else:
            said = rng.choice(["AKIA" + some(string.ascii_uppercase + string.digits, 16), "password=" + some("0123456789abcdef", 18), 'token = "' + some("0123456789abcdef", 40) + '"', "sk-" + some(string.ascii_letters + string.digits, 32), "ghp_" + some(string.ascii_letters + string.digits, 36)])
            before = rng.choice([["key"], ["secret"], [], [], []])
        if rng.random() < 0.6:  # in running text anything may stand before an item, and a mark after it
            before = []
        return before, f"{kind}\t{said}{rng.choice(['', '', '', ',', '.', '!', '?', ';'])}"

    def lookalike() -> list[str]:
        return rng.choice([["in", f"19{digits(2)}"], ["page", digits(2)], [f"{digits(2)}.{digits(2)}"], [f"{digits(2)}:{digits(2)}"], ["at", "home"], ["dot", "com"], [f"{digits(4)}-{digits(2)}-{digits(2)}"], ["version", f"{digits(1)}.{digits(1)}"], [f"{digits(1)},{digits(3)}"], [digits(1)], [digits(5)], ["|"], [f"+1 ({digits(3)}) {digits(3)}-{digits(4)}"], [f"{some('abc', 4)}@mail.example.com"], [digits(16)], [f"{digits(2)}.{digits(3)}.{digits(2)}.{digits(3)}"], ["password"], ["token"], ["call"], ["id"]])

    out = []
    for _ in range(sentences):
        words, tags = [], []
        for part in range(rng.randint(1, 3)):
            filler = [word() for _ in range(rng.randint(1, 6))]
            if rng.random() < 0.12:
                filler += [word()] * rng.randint(2, 12)
            words += filler
            tags += ["O"] * len(filler)
            pick = rng.random()
            if pick < 0.45:
                before, (kind, said) = (lambda b, s: (b, s.split("\t")))(*item())
                words += before + said.split(" ")
                n = len(said.split(" "))
                tags += ["O"] * len(before) + [f"B-{kind}"] + [f"I-{kind}"] * (n - 1)
            elif pick < 0.8:
                extra = " ".join(lookalike()).split(" ")
                words += extra
                tags += ["O"] * len(extra)
        out.append((words, tags))
    return out


@functools.lru_cache(maxsize=2)
def default_model(p: Params) -> Crf:
    return train(examples(p.sentences, p.seed))


def model_from(labelled: DataFrame, p: Params = Params()) -> Crf:
    """A model from a table (words array<string>, tags array<string>), of which at most ``max_examples`` rows by hash are used."""
    rows = labelled.where("words is not null and size(words) > 0 and size(words) = size(tags)").orderBy(F.xxhash64("words")).limit(p.max_examples).collect()
    return train([(list(r.words), list(r.tags)) for r in rows])


def added_spans(model: Crf, buf: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """Spans of the random field for each row, in code points of the row."""
    w = model.words(buf, offsets)
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    tags = model.decode(w)
    found = np.flatnonzero(tags)
    if not len(found):
        return out
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    row = np.searchsorted(w.ptr, found, "right") - 1
    last = (-2, "", -1)
    for i, r in zip(found.tolist(), row.tolist(), strict=True):
        lead, kind = model.labels[tags[i]].split("-")
        a, b = int(w.starts[i]), int(w.ends[i])
        while b - a > 1 and buf[b - 1] in b".,;:!?\"')|":
            b -= 1
        span = (kind, int(points[a] - points[offsets[r]]), int(points[b] - points[offsets[r]]))
        if lead == "I" and last == (i - 1, kind, r):
            out[r][-1] = (kind, out[r][-1][1], span[2])
        else:
            out[r].append(span)
        last = (i, kind, r)
    return out


def find(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, the numbers of base spans, base_sha256, and spans (base and added)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some hundred kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in K.slices(batch.column("text")):
                added = added_spans(shared.value, buf, offsets)
                counts, sha, said = [], [], []
                for text, more in zip(batch.column("text").slice(first, end - first).to_pylist(), added, strict=True):
                    base = base_spans(text)
                    counts.append([sum(k == kind for k, _, _ in base) for kind in BASE] if base else [0] * len(BASE))
                    sha.append(hashlib.sha256(written(base).encode()).hexdigest())
                    said.append(written(base + [s for s in more if all(s[2] <= a or b <= s[1] for _, a, b in base)]))
                numbers = np.array(counts, np.int64).reshape(-1, len(BASE)).T
                yield pa.record_batch([batch.column("doc_id").slice(first, end - first), *(pa.array(x) for x in numbers), pa.array(sha), pa.array(said)], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
