"""Counting of 64-bit hashes within a task, and bit sets of bounded size made from hashes in Spark."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD, MAX_BITS = 1_500_000, 28


def mix(h: np.ndarray) -> np.ndarray:
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class HashCounts:
    """Occurrences of hashes; holds at most about ``HELD`` of them before they must be handed on.

    Hashes are kept as they come and sorted ``HELD`` at a time, which is far cheaper than to merge them slice by slice."""

    def __init__(self) -> None:
        self.raw: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = self.size = 0

    def add(self, h: np.ndarray) -> None:
        self.raw.append(h)
        self.waiting += len(h)
        if self.waiting > HELD:
            self._sort()

    def _sort(self) -> None:
        h = np.concatenate(self.raw)
        self.raw, self.waiting = [], 0
        h.sort()
        at = _firsts(h)
        self.parts.append((h[at], np.diff(at, append=len(h))))
        self.size += len(at)
        if self.size > HELD and len(self.parts) > 1:
            self._merge()

    def _merge(self) -> None:
        h, c = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(h)
        h, c = h[order], c[order]
        at = _firsts(h)
        self.parts, self.size = [(h[at], np.add.reduceat(c, at) if len(at) else c)], len(at)

    def full(self) -> bool:
        return self.size > HELD // 2

    def rows(self) -> pd.DataFrame:
        """(h, c) rows of what is held, which is then forgotten."""
        if self.raw:
            self._sort()
        if len(self.parts) > 1:
            self._merge()
        h, c = self.parts[0] if self.parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.parts, self.size = [], 0
        return pd.DataFrame({"h": h.view(np.int64), "c": c.astype(np.int64, copy=False)})


def _firsts(h: np.ndarray) -> np.ndarray:
    """Where each value of sorted hashes begins."""
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return np.flatnonzero(new)


class Bits:
    """A set of hashes as bits; may hold more than was put in, never less."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.bits)
        return (self.data[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_set(hashes: DataFrame, max_bits: int = MAX_BITS, for_each: int = 16) -> Bits:
    """The long column ``h`` as bits: ``for_each`` a hash, at most 2 ** max_bits in all, set by aggregation in Spark."""
    bits = min(max_bits, max(10, (for_each * hashes.count()).bit_length()))
    word, bit = f"shiftrightunsigned(h, {64 - bits + 6})", f"cast(shiftrightunsigned(h, {64 - bits}) & 63 as int)"
    held = hashes.groupBy(F.expr(word).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("bits")).toArrow()
    data = np.zeros(1 << bits - 6, np.uint64)
    data[held["word"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    return Bits(bits, data)
