"""Best-fit packing by minimum bin slack.

Documents become token ids plus a closing id 0; only those longer than a bin are
cut into full pieces and a rest.  The pieces' lengths, a histogram of at most
``size`` entries whatever the corpus, are packed bin by bin: the largest length
left opens a bin, and a bitset subset-sum over the lengths still available finds
the fullest feasible combination for the rest of it.  A combination is removed as
often as the histogram holds it before the next one is looked for, which is what
one bin at a time would choose.  Pieces then get their place by their rank among
the pieces of equal length, counted per partition, so no length meets in one task.

Defined results: a null text is an empty text and is one piece of length 1 (the
closing id); repeated rows are packed each; an empty table gives no row; ties in
length go by partition order, which does not change the number of sequences.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.common import cut, give_back_memory, table, text_slices, vocabulary_path, worker_memo

SIZE = 2048


# The split rule of the default tokenizer, and the words that it splits by kind of character alone.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = "^[!-&(-~À-ÖØ-öø-ÿ]*$"
LONG = 64
NONE = 1 << 30
TABLE_BITS = 18


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings end to end, and where each begins and the last one ends."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, ends - ends[0]


class WordEncoder:
    """Ids of white-space separated words.  No token spans white space, so a text's ids are those of its words.

    With the default tokenizer's rules, words of Western letters, digits and ASCII signs are split by kind of
    character, and the tokenizer's merges are applied to all their parts at once, always the leftmost pair of the
    lowest rank.  All other words, and words of over ``LONG`` bytes, go through the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        model, split = rules["model"], ((rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0].get("pattern", {})
        self.plain = (split.get("Regex") == SPLIT and model.get("end_of_word_suffix") == "</w>" and not model.get("ignore_merges")
                      and all(t["content"].startswith("<|") for t in rules["added_tokens"]))
        if not self.plain:
            return
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = len(ids) + 1
        key = np.array([ids[x] * self.size + ids[y] for x, y in pairs], np.int64)
        # Pairs by hash, in open addressing: a free slot ends a search.
        self.keys, self.ranks = np.full(1 << TABLE_BITS, -1, np.int64), np.full(1 << TABLE_BITS, NONE, np.int32)
        slot, left = self._slot(key), np.arange(len(key))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]], self.ranks[slot[free]] = key[free], free  # one of several takes a slot
            left = left[self.keys[slot[left]] != key[left]]
            slot[left] = (slot[left] + 1) % len(self.keys)
        self.merged = np.array([ids[x + y] for x, y in pairs], np.int32)
        marks = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        of_byte = {}
        for char in map(chr, range(0x21, 0x100)):
            for byte, mark in zip(char.encode(), marks.pre_tokenize_str(char)[0][0], strict=True):
                of_byte[byte] = mark
        self.first, self.last = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for byte, mark in of_byte.items():
            self.first[byte], self.last[byte] = ids[mark], ids[mark + "</w>"]
        kind = np.full(256, 2, np.uint8)
        kind[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = 0
        kind[ord("0"):ord("9") + 1] = 1
        self.kind = kind

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) * self.size + right).ravel()
        slot = self._slot(key)
        found = self.keys[slot]
        rank = np.where(found == key, self.ranks[slot], NONE)
        go = np.flatnonzero((found != key) & (found >= 0))
        while len(go):
            slot[go] = (slot[go] + 1) % len(self.keys)
            found = self.keys[slot[go]]
            rank[go] = np.where(found == key[go], self.ranks[slot[go]], NONE)
            go = go[(found != key[go]) & (found >= 0)]
        return rank.reshape(left.shape)

    def _merge(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, ids) of parts of one length, as they have no pair left to merge."""
        rows, rank = np.arange(len(ids)), self._rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if ids.shape[1] == 1:
                yield rows, ids
                return
            best = rank.argmin(1)
            low = rank[np.arange(len(rows)), best]
            go = low < NONE
            if not go.all():
                yield rows[~go], ids[~go]
                rows, ids, rank, best, low = rows[go], ids[go], rank[go], best[go], low[go]
            all_, left = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, left + (left > best[:, None]), 1)
            ids[all_, best] = self.merged[low]
            rank = np.take_along_axis(rank, left[:-1] + (left[:-1] >= best[:, None]), 1)
            before, after = np.flatnonzero(best > 0), np.flatnonzero(best < ids.shape[1] - 1)
            rank[before, best[before] - 1] = self._rank(ids[before, best[before] - 1], ids[before, best[before]])
            rank[after, best[after]] = self._rank(ids[after, best[after]], ids[after, best[after] + 1])

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts end to end, and how many each has."""
        raw, ends = _bytes_of(parts)
        starts, sizes = ends[:-1], np.diff(ends)
        done, count = [], np.zeros(len(starts), np.int64)
        for n in np.unique(sizes):
            at = np.flatnonzero(sizes == n)
            for part in np.array_split(at, -(-len(at) // 20_000)):
                ids = self.first[raw[starts[part][:, None] + np.arange(n)]]
                ids[:, -1] = self.last[raw[starts[part] + n - 1]]
                for rows, final in self._merge(ids):
                    done.append((part[rows], final))
                    count[part[rows]] = final.shape[1]
        place, flat = np.cumsum(count) - count, np.empty(int(count.sum()), "<u4")
        for part, final in done:
            flat[place[part][:, None] + np.arange(final.shape[1])] = final
        return flat, count

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words end to end, and how many each has; every distinct part is merged once."""
        raw, ends = _bytes_of(pc.utf8_lower(words))
        kind = self.kind[raw]
        new = np.ones(len(raw) + 1, bool)
        new[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
        new[ends] = True
        starts = np.flatnonzero(new)
        parts = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(raw)).dictionary_encode()
        flat, count = self._parts(parts.dictionary)
        part = parts.indices.to_numpy(zero_copy_only=False)
        n = count[part]
        until = np.concatenate([[0], np.cumsum(n)])
        first = (np.cumsum(count) - count)[part]
        of_word = until[np.searchsorted(starts, ends)]
        return flat[np.repeat(first - until[:-1], n) + np.arange(until[-1])], np.diff(of_word)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has."""
        own = np.zeros(len(words), bool)
        if self.plain and len(words):
            own = (pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
                   & (pc.binary_length(words).to_numpy(zero_copy_only=False) <= LONG)
                   & ~pc.match_substring(words, "<|").to_numpy(zero_copy_only=False))
        flat, own_count = self._plain(words.filter(pa.array(own))) if own.any() else (np.empty(0, "<u4"), np.empty(0, np.int64))
        if own.all():
            return flat, own_count
        count, other, held = np.zeros(len(words), np.int64), np.flatnonzero(~own), []
        for k in range(0, len(other), 20_000):
            at = other[k:k + 20_000]
            found = self.tokenizer.encode_batch_fast(words.take(pa.array(at)).to_pylist(), add_special_tokens=False)
            held += [np.array(e.ids, "<u4") for e in found]
        count[own], count[other] = own_count, list(map(len, held))
        whole = np.empty(int(count.sum()), "<u4")
        whole[np.repeat(own, count)] = flat
        whole[np.repeat(~own, count)] = np.concatenate(held)
        return whole, count


def encode_texts(texts: list[str], encoder: WordEncoder, size: int) -> list[list[dict]]:
    """The pieces of each text; every distinct word of the texts is encoded once."""
    words = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
    coded = words.flatten().dictionary_encode()
    bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
    word, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    del words, coded  # the words themselves are needed once each from here on
    flat, count = encoder.encode(distinct)
    n, out = count[word], []
    first = (np.cumsum(count) - count)[word]
    ends = np.concatenate([[0], np.cumsum(n)])
    for k in range(len(texts)):
        a, b = bounds[k], bounds[k + 1]
        own = np.zeros(ends[b] - ends[a] + 1, "<u4")  # with the closing id
        own[:-1] = flat[np.repeat(first[a:b] - ends[a:b] + ends[a], n[a:b]) + np.arange(len(own) - 1)]
        out.append([{"piece": p, "start": p * size, "length": len(cut_), "ids_crc32": zlib.crc32(cut_)}
                    for p in range(-(-len(own) // size)) for cut_ in (own[p * size:(p + 1) * size],)])
    return out


def encode_udf(path: str, size: int = SIZE):
    """Pieces of each text: array of (piece, start, length, crc32 of the ids)."""

    @F.pandas_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        held = worker_memo(f"encoder:{path}", 1 << 30)
        if not held:
            held["encoder"] = WordEncoder(path)
        for texts in batches:
            out = []
            for own in text_slices(texts, 6_000_000):
                out += encode_texts(own, held["encoder"], size)
                give_back_memory()
            yield pd.Series(out)
            give_back_memory()

    return encode


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths (with repeats) from ``counts`` whose sum is the largest that fits ``room``; large ones first."""
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left > 0:
            take = min(step, left)
            steps.append((reach, length * take, length, take))
            reach |= (reach << (length * take)) & full
            left, step = left - take, step * 2
        if reach >> room:
            break
    at, chosen = reach.bit_length() - 1, []
    for before, weight, length, take in reversed(steps):
        if not before >> at & 1:
            at -= weight
            chosen += [length] * take
    return chosen


def plan(histogram: dict[int, int], size: int = SIZE) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Rows (length, first rank, end rank, copies in a bin, first bin, offset in the bin), and the number of bins."""
    left = {n: c for n, c in histogram.items() if c > 0}
    used, rows, bins = dict.fromkeys(left, 0), [], 0
    while left:
        largest = max(left)
        rest = left | {largest: left[largest] - 1}
        chosen = [largest, *fullest({n: c for n, c in rest.items() if c}, size - largest)]
        copies = {n: chosen.count(n) for n in dict.fromkeys(chosen)}
        times, offset = min(left[n] // m for n, m in copies.items()), 0
        for n, m in copies.items():
            rows.append((n, used[n], used[n] + times * m, m, bins, offset))
            offset += n * m
            used[n] += times * m
            left[n] -= times * m
            if not left[n]:
                del left[n]
        bins += times
    return rows, bins


def place_udf(spark: SparkSession, rows: list[tuple[int, int, int, int, int, int]]):
    """(length, rank) to (sequence_id, offset) by the plan, whose size depends on the bin size alone."""
    shared = spark.sparkContext.broadcast(np.array(sorted(rows), np.int64).reshape(-1, 6))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        p = shared.value
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        of_length = np.searchsorted(p[:, 0], n)
        by_end = np.lexsort((p[:, 1], p[:, 0]))
        lo, hi = of_length, np.searchsorted(p[:, 0], n, "right")
        while (lo + 1 < hi).any():  # binary search within the rows of the length
            mid = (lo + hi) // 2
            right = p[by_end[np.minimum(mid, len(p) - 1)], 1] <= r
            lo, hi = np.where(right & (lo + 1 < hi), mid, lo), np.where(~right & (lo + 1 < hi), mid, hi)
        _, first, _, copies, bins, offset = p[by_end[lo]].T
        k = r - first
        return pd.DataFrame({"sequence_id": bins + k // copies, "offset": offset + k % copies * n})

    return place


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         size: int = SIZE) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark, path = docs.sparkSession, path or vocabulary_path("word_bpe_49k.json")
    pieces = docs.select(F.col(id_col).alias("doc_id"), encode_udf(path, size)(F.col(text_col)).alias("p"))
    pieces = cut(pieces.select("doc_id", F.explode("p").alias("p")).select("doc_id", "p.*")
                 .withColumn("_part", F.spark_partition_id()))
    counts = pieces.groupBy("_part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    firsts = counts.select("_part", "length", F.coalesce(before, F.lit(0)).alias("_first"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(histogram, size)
    within = F.row_number().over(W.partitionBy("_part", "length").orderBy("doc_id", "piece")) - 1
    ranked = (pieces.withColumn("_within", within).join(firsts, ["_part", "length"])
              .withColumn("_at", place_udf(spark, rows)(F.col("length"), F.col("_within") + F.col("_first"))))
    return ranked.select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32",
                         "_at.sequence_id", "_at.offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
