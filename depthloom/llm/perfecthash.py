"""A minimal perfect hash over 64-bit keys with stored fingerprints, in numpy.

Levels of bit arrays: a key that is alone at its place of a level sets the bit there and rests;
keys that meet go on to the next level, with another seed. A key's slot is the number of bits set
before its own, so n keys get the slots 0 to n - 1. A lookup reads one bit of a few levels,
whatever n is. A key outside the set reaches no bit or a slot whose fingerprint differs, but for one
in 2**32, or one in 2**64 where the caller compares the stored key too.
"""

from __future__ import annotations

import io

import numpy as np

from depthloom.llm.textkernel import mix

MAGIC = b"MPHIDX01"
GAMMA = 2
MAX_LEVELS = 64


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ np.uint64((level * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1))) % np.uint64(size)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xF1A9F1A9F1A9F1A9)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, sizes: np.ndarray, words: np.ndarray, prints: np.ndarray) -> None:
        self.sizes, self.words, self.prints = sizes, words, prints
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct uint64."""
        left, sizes, bits, level = np.asarray(keys, np.uint64), [], [], 0
        while len(left):
            if level == MAX_LEVELS:
                raise ValueError("keys repeat")
            size = (GAMMA * len(left) + 63) // 64 * 64
            place = _place(left, level, size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left, level = left[~alone[place]], level + 1
        flags = np.concatenate(bits) if bits else np.zeros(0, bool)
        words = np.packbits(flags, bitorder="little").view("<u8")
        out = cls(np.array(sizes, np.int64), words.astype(np.uint64), np.zeros(len(keys), np.uint32))
        out.prints[out._slots(np.asarray(keys, np.uint64))] = fingerprint(np.asarray(keys, np.uint64))
        return out

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slot, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, start) in enumerate(zip(self.sizes, self.starts, strict=True)):
            at = start + _place(keys[left], level, int(size))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            have = self.words[word]
            hit = (have >> bit) & np.uint64(1) == 1
            below = have & ((np.uint64(1) << bit) - np.uint64(1))
            slot[left[hit]] = (self.before[word] + np.bitwise_count(below))[hit]
            left = left[~hit]
            if not len(left):
                break
        return slot

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for one whose fingerprint is not stored."""
        keys = np.asarray(keys, np.uint64)
        slot = self._slots(keys)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == fingerprint(keys[known])
        return np.where(known, slot, -1)

    def to_bytes(self, **columns: np.ndarray) -> bytes:
        """The index with columns of one value a slot, in slot order."""
        out = io.BytesIO()
        np.savez(out, sizes=self.sizes, words=self.words, prints=self.prints, **columns)
        return MAGIC + out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple[PerfectHash, dict[str, np.ndarray]]:
        if raw[: len(MAGIC)] != MAGIC:
            raise ValueError("not an index file")
        with np.load(io.BytesIO(raw[len(MAGIC) :])) as z:
            data = {k: z[k] for k in z.files}
        return cls(data.pop("sizes"), data.pop("words"), data.pop("prints")), data
