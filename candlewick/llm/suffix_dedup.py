"""Removal of repeated passages by maximal repeats of an enhanced suffix array.

Only text around repeated anchors can hold a repeat of ``length`` bytes, so that is all that is sorted:

1. Every window of ``length`` bytes has an anchor: its ``gram`` bytes with the least hash.  Equal
   windows have equal anchors.  Anchors are counted by hash over all texts; those seen once go.
2. A context is an anchor with all windows that hold it.  Of equal contexts all but the first place
   go; a task settles what it can of its own texts, so at most one place of a context leaves it.
3. First places of contexts with one anchor form a group.  Their texts are suffix-sorted; a stack scan of the
   common-prefix lengths gives the interval tree, and intervals whose members differ in the byte
   before them are the maximal repeats, with all their places.  All but the first place of a repeat is removed.
4. Groups of more than ``crowd`` contexts are dealt by longer keys around the anchor (windows that start 9 bytes
   or 1 byte apart), so a passage of any frequency is split and nothing is left out.

Byte ranges are collected by document and merged.  Bit sets of bounded size keep scans from
handing on what cannot matter; what they let through by chance is harmless.

Defined results: a null text is empty and loses nothing; a place is earlier by smaller doc_id, null first, then by start; rows
with one id are one document with several texts, so rows equal in id and text keep the same bytes;
texts of any length are read whole, in blocks; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.common import cut, give_back_memory, shared_folder, table, text_slices
from candlewick.llm.hashes import MAX_BITS, Bits, HashCounts, bit_set, mix

LENGTH, GRAM, RUN, CHUNK, HELD = 100, 32, 6000, 1 << 16, 1_000_000
#: Contexts that one task sorts at a time at most: under 6 MB of text at 168 bytes each, some hundred MB with all ranks.
CROWD = 32_768
STEPS = (9, 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _gram_order(data: np.ndarray, gram: int) -> np.ndarray:
    """32-bit hashes of all runs of ``gram`` bytes (a power of two), by doubling."""
    h, k, base = data.astype(np.uint32) + np.uint32(1), 1, 0x9E3779B1
    while k < gram:
        h = h[:len(h) - k] * np.uint32(base) + h[k:] if len(h) > k else h[:0]
        base, k = base * base % (1 << 32) | 1, 2 * k
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def _gram_hashes(data: np.ndarray, at: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of the ``gram`` bytes at some places."""
    words = np.ascontiguousarray(data[at[:, None] + np.arange(gram)]).view(np.uint64)
    h = np.full(len(at), gram, np.uint64)
    for j in range(words.shape[1]):
        h = mix(h * _ODD + words[:, j])
    return h


def _sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        x, k = of(x[:-k], x[k:]), 2 * k
    return of(x[:len(x) - (width - k)], x[width - k:]) if width > k else x


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM,
            chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of texts that lie end to end, by place."""
    width, found = length - gram + 1, [np.empty(0, np.int64)]
    of_window = np.zeros(len(data) + 1, np.int8)  # which windows lie in one text
    whole = ends - starts >= length
    np.add.at(of_window, starts[whole], 1)
    np.add.at(of_window, ends[whole] - length + 1, -1)
    inside = np.cumsum(of_window[:-1], dtype=np.int8).astype(bool)
    edge = np.zeros(width - 1, np.uint32)
    for a in range(0, len(data) - length + 1, chunk):
        b = min(a + chunk, len(data) - length + 1)
        if not inside[a:b].any():
            continue
        h = _gram_order(data[a:b + length - 1], gram)
        np.maximum(h, np.uint32(1), out=h)
        least = np.where(inside[a:b], _sliding(h, width, np.minimum), np.uint32(0))  # 0: no window
        found.append(np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == h) + a)
    at = np.unique(np.concatenate(found))
    return at, _gram_hashes(data, at, gram)


def _slices(batch: pd.DataFrame, length: int, gram: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of some rows at a time: their bytes, and per anchor its text's start and end, its row in the batch, place and hash."""
    done = 0
    for texts in text_slices(batch["text"], 4_000_000):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        ends = np.cumsum([len(r) for r in raw])
        starts = ends - [len(r) for r in raw]
        data = b"".join(raw)
        at, h = anchors(np.frombuffer(data, np.uint8), starts, ends, length, gram)
        own = np.searchsorted(ends, at, "right")
        yield data, starts[own], ends[own], own + done, at, h
        done += len(texts)


def repeated_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(h): hashes of anchors seen twice or more."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = HashCounts()
        for batch in batches:
            for *_, h in _slices(batch, length, gram):
                held.add(h)
                if held.full():
                    yield held.rows()
            give_back_memory()
        yield held.rows()

    return docs.select("text").mapInPandas(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where("c > 1").select("h")


def _context_id(context: bytes, off: int) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(context, seed=off)


def _doc_order(doc: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers that sort as they do, null first, by two keys."""
    ids = doc.astype("Int64")
    return ids.notna().to_numpy(), ids.fillna(0).to_numpy(np.int64)


def _joined(start: np.ndarray, end: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each owner, those that touch or overlap joined: starts, ends and owners in order."""
    order = np.lexsort((start, own))
    start, end, own = start[order], end[order], own[order]
    wide = np.int64(end.max(initial=0) + 2)
    reach = np.maximum.accumulate(end + own * wide)
    new = np.concatenate([[True], start[1:] + own[1:] * wide > reach[:-1]]) if len(own) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own)) - 1 if len(first) else first
    return start[first], reach[last] - own[first] * wide, own[first]


def _span_rows(start: np.ndarray, end: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Owners that have ranges, and the joined ranges of each as starts and ends in turn."""
    start, end, own = _joined(start, end, own)
    who, first = np.unique(own, return_index=True)
    flat = np.stack([start, end], 1).ravel().astype(np.int32)
    return who, np.split(flat, 2 * first[1:]) if len(who) else []


_PLACES = "h long, k long, doc_id long, th long, at int, off int, size int, spans array<int>"


def places(docs: DataFrame, bits: Bits, length: int, gram: int) -> DataFrame:
    """What each task finds at repeated anchors: the first places of its contexts, and by text the spans of all its later places.

    First places have hash, context, document, place, and the context's offset and size; spans are keyed by their text."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    reach = length - gram

    def settled(held: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(held, ignore_index=True).drop_duplicates(["h", "k", "doc_id", "th", "at"], ignore_index=True)
        known, doc = _doc_order(rows["doc_id"])
        order = np.lexsort((rows["at"], doc, known, rows["k"], rows["h"]))
        rows, known, doc = rows.iloc[order].reset_index(drop=True), known[order], doc[order]
        h, k, at = rows["h"].to_numpy(), rows["k"].to_numpy(), rows["at"].to_numpy()
        start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])]))
        least = np.repeat(start, np.diff(np.append(start, len(rows))))
        later = (at != at[least]) | (doc != doc[least]) | (known != known[least])
        out = rows[~later].copy()
        out["spans"] = None
        if not later.any():
            return out
        rest = rows[later]
        text = rest.groupby(["doc_id", "th"], dropna=False, sort=False).ngroup().to_numpy()
        who, spans = _span_rows((rest["at"] - rest["off"]).to_numpy(np.int64), (rest["at"] - rest["off"] + rest["size"]).to_numpy(np.int64), text)
        one = rest.iloc[np.unique(text, return_index=True)[1]]
        told = pd.DataFrame({"h": one["th"].to_numpy(), "k": 0, "doc_id": one["doc_id"].array, "th": one["th"].to_numpy(), "at": 0, "off": 0, "size": 0})
        told["spans"] = pd.Series(spans, dtype=object)
        return pd.concat([out, told], ignore_index=True)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, held, n = shared.value, [], 0
        for batch in batches:
            ids, keys = batch["doc_id"].astype("Int64"), batch["th"].to_numpy()
            for data, starts, ends, row, at, h in _slices(batch, length, gram):
                keep = np.flatnonzero(bits.has(h))
                starts, ends, row, at, h = starts[keep], ends[keep], row[keep], at[keep], h[keep]
                lo, hi = np.maximum(starts, at - reach), np.minimum(ends, at + length)
                k = np.fromiter((_context_id(data[a:b], o) for a, b, o in zip(lo.tolist(), hi.tolist(), (at - lo).tolist(), strict=True)), np.uint64, len(at))
                held.append(pd.DataFrame({"h": h.view(np.int64), "k": k.view(np.int64), "doc_id": ids.iloc[row].array, "th": keys[row],
                                          "at": (at - starts).astype(np.int32), "off": (at - lo).astype(np.int32), "size": (hi - lo).astype(np.int32)}))
                n += len(at)
                if n > HELD:
                    yield settled(held)
                    held, n = [], 0
            give_back_memory()
        if n:
            yield settled(held)

    return docs.select("doc_id", "th", "text").mapInPandas(find, _PLACES)


def _place_hash(h: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(h ^ mix(doc.astype(np.int64).view(np.uint64) * _ODD + at.astype(np.uint64)))


_CONTEXTS = "h long, k long, doc_id long, th long, at int, off int, ctx binary"


def context_texts(docs: DataFrame, first: DataFrame, groups: DataFrame, length: int, gram: int, max_bits: int) -> DataFrame:
    """The places ``first`` (h, doc_id, at) whose hash is in ``groups`` (h), with their contexts; a few more may come along."""
    @F.pandas_udf("long")
    def named(h: pd.Series, doc: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series(_place_hash(h.to_numpy(np.int64).view(np.uint64), doc.to_numpy(np.int64), at.to_numpy(np.int64)).view(np.int64))

    doc = F.coalesce("doc_id", F.lit(0).cast("long"))
    wanted = first.join(F.broadcast(groups), "h", "left_semi") if groups.count() <= 100_000 else first
    bits = bit_set(cut(wanted.select(named("h", doc, "at").alias("h"))), max_bits, 64)
    shared = docs.sparkSession.sparkContext.broadcast((bits, bit_set(groups, max_bits)))
    reach = length - gram

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, known = shared.value
        for batch in batches:
            ids, keys = batch["doc_id"].astype("Int64"), batch["th"].to_numpy()
            number = ids.fillna(0).to_numpy(np.int64)
            for data, starts, ends, row, at, h in _slices(batch, length, gram):
                keep = np.flatnonzero(known.has(h))
                keep = keep[bits.has(_place_hash(h[keep], number[row[keep]], (at - starts)[keep]))]
                starts, ends, row, at, h = starts[keep], ends[keep], row[keep], at[keep], h[keep]
                lo, hi = np.maximum(starts, at - reach), np.minimum(ends, at + length)
                own = [data[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                k = np.fromiter(map(_context_id, own, (at - lo).tolist()), np.uint64, len(own))
                yield pd.DataFrame({"h": h.view(np.int64), "k": k.view(np.int64), "doc_id": ids.iloc[row].array, "th": keys[row],
                                    "at": (at - starts).astype(np.int32), "off": (at - lo).astype(np.int32), "ctx": pd.Series(own, dtype=object)})
            give_back_memory()

    return docs.select("doc_id", "th", "text").mapInPandas(find, _CONTEXTS)


def maximal_repeats(texts: list[bytes], group: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bytes, text numbers, offsets) of every maximal repeat of ``length`` bytes or more among the texts of a group.

    A text's start counts as unlike any other byte before a repeat.
    """
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    wide = int(size.max(initial=0))
    if wide < length:
        return
    own = np.zeros((len(texts), wide), np.uint8)
    own[np.arange(wide) < size[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
    # Suffixes that share a hash of their first bytes; the others are in no repeat and need not be sorted.
    h, k, base = own.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while 2 * k <= length:
        h = h[:, :-k] * np.uint64(base) + h[:, k:]
        base, k = base * base % (1 << 64) | 1, 2 * k
    n = wide - length + 1
    h = mix(h[:, :n] * _ODD + h[:, length - k:length - k + n])
    text, off = np.nonzero(np.arange(n) + length <= size[:, None])
    key = mix(h[text, off] ^ (group[text].astype(np.uint64) * _ODD))
    order = np.argsort(key)
    key, text, off = key[order], text[order], off[order]
    left = np.where(off > 0, own[text, np.maximum(off, 1) - 1].astype(np.int64), -1 - np.arange(len(off)))
    # Of a class whose members agree in the byte before, nothing is maximal.
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    diverse = np.minimum.reduceat(left, start) != np.maximum.reduceat(left, start) if len(start) else np.empty(0, bool)
    keep = np.repeat(diverse, np.diff(np.append(start, len(key))))
    text, off, left = text[keep], off[keep], left[keep]
    if not len(text):
        return
    # Ranks of the first bytes, exact and in order: classes are compared byte by byte with their first member.
    key = key[keep]
    of = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
    del h, key, order, keep
    lead, heads, slices = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])), sliding_window_view(own, length, axis=1), range(0, len(of), 50_000)
    for a in slices:
        i = lead[of[a:a + 50_000]]
        if (heads[text[a:a + 50_000], off[a:a + 50_000]] != heads[text[i], off[i]]).any() or (group[text[a:a + 50_000]] != group[text[i]]).any():
            of, lead = np.arange(len(text)), np.arange(len(text))  # two strings under one hash: each suffix for itself until ranked
            break
    head, own_group = np.ascontiguousarray(heads[text[lead], off[lead]]).view(f"S{length}").ravel(), group[text[lead]]
    order = np.lexsort((head, own_group))
    rank = np.empty(len(lead), np.int64)
    rank[order] = np.cumsum(np.concatenate([[False], (head[order[1:]] != head[order[:-1]]) | (own_group[order[1:]] != own_group[order[:-1]])]))
    of, rest = rank[of], max(wide - length, 1)
    del head, rank
    own = np.pad(own, ((0, 0), (0, rest)))
    tail, more = sliding_window_view(own, rest, axis=1)[text, off + length], size[text] - off - length
    order = np.lexsort((more, tail.view(f"S{rest}").ravel(), of))
    text, off, left, of, more = text[order], off[order], left[order], of[order], more[order]
    common = np.minimum(more[1:], more[:-1])
    for a in slices:
        unlike = tail[order[a + 1:a + 50_001]] != tail[order[a:a + 50_000][:len(order) - a - 1]]
        common[a:a + 50_000] = np.minimum(common[a:a + 50_000], np.where(unlike.any(1), unlike.argmax(1), rest))
    common = np.where(of[1:] == of[:-1], length + common, 0)
    del tail
    changes = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    stack: list[tuple[int, int]] = []
    for i, lcp in enumerate(common.tolist() + [0], 1):  # the common-prefix interval tree, by a stack scan
        first = i - 1
        while stack and lcp < stack[-1][0]:
            deep, first = stack.pop()
            if changes[i - 1] > changes[first]:
                yield deep, text[first:i], off[first:i]
        if lcp >= length and (not stack or lcp > stack[-1][0]):
            stack.append((lcp, first))


_SPANS = "doc_id long, th long, spans array<int>"


def _covered(run: pd.DataFrame, length: int) -> pd.DataFrame:
    """Spans of the first places of some whole groups' contexts that repeat an earlier place."""
    known, doc = _doc_order(run["doc_id"])
    order = np.lexsort((run["at"], doc, known, run["k"], run["h"]))
    run, known, doc = run.iloc[order], known[order], doc[order]
    h, k, at = run["h"].to_numpy(), run["k"].to_numpy(), run["at"].to_numpy(np.int64)
    start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])]))  # the least place of each context
    of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(run))))
    tied = (at == at[start[of]]) & (doc == doc[start[of]]) & (known == known[start[of]])
    rank = np.unique(np.stack([known[start].astype(np.int64), doc[start]], 1), axis=0, return_inverse=True)[1].ravel()
    begin = rank * (1 << 33) + at[start] - run["off"].to_numpy(np.int64)[start] + length
    group = np.unique(h[start], return_inverse=True)[1]
    texts = run["ctx"].iloc[start].tolist()
    reach = np.zeros((len(texts), max(map(len, texts)) + 1), np.int32)  # the furthest end of a repeat from each place
    for size, text, off in maximal_repeats(texts, group, length):
        place = begin[text] + off
        again = place > place.min()
        text, off = text[again], off[again]
        reach[text, off] = np.maximum(reach[text, off], off + size)
    text, off = np.nonzero(reach)
    if not len(text):
        return pd.DataFrame({"doc_id": pd.array([], "Int64"), "th": np.empty(0, np.int64), "spans": pd.Series([], dtype=object)})
    who, spans = _span_rows(off, reach[text, off].astype(np.int64), text)
    of_context = dict(zip(who.tolist(), spans, strict=True))
    rows = [i for i in np.flatnonzero(tied) if of[i] in of_context]
    shift = at - run["off"].to_numpy(np.int64)
    return pd.DataFrame({"doc_id": run["doc_id"].astype("Int64").iloc[rows].array, "th": run["th"].to_numpy()[rows],
                         "spans": pd.Series([(of_context[of[i]] + shift[i]).astype(np.int32) for i in rows], dtype=object)})


def _sorted_groups(contexts: DataFrame, length: int, run: int) -> DataFrame:
    """Spans of contexts whose groups are small, some groups at a time."""

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < run:
                continue
            rows = pd.concat(held, ignore_index=True)
            whole = rows["h"] != rows["h"].iat[-1]  # the last group may go on
            if whole.any():
                yield _covered(rows[whole].reset_index(drop=True), length)
                give_back_memory()
            held = [rows[~whole]]
        if held and sum(map(len, held)):
            yield _covered(pd.concat(held, ignore_index=True), length)

    return contexts.repartition("h").sortWithinPartitions("h").mapInPandas(cover, _SPANS)


def _split(crowded: DataFrame, step: int, length: int, gram: int) -> DataFrame:
    """Each context of a crowded group under longer keys: its windows that start ``step`` bytes apart."""
    reach = length - gram

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, rows = [], []
            for i, (off, ctx) in enumerate(zip(batch["off"].tolist(), batch["ctx"], strict=True)):
                for back in range(0, reach + 1, step):
                    a, b = off - back, off - back + length + 1 - step
                    if a < 0 or b > len(ctx):
                        continue
                    lo, hi = max(0, a - step + 1), min(len(ctx), a + length)
                    out.append((_context_id(ctx[a:b], back * 1000 + step), _context_id(ctx[lo:hi], off - lo), off - lo, ctx[lo:hi]))
                    rows.append(i)
            yield pd.DataFrame({"h": np.array([r[0] for r in out], np.uint64).view(np.int64), "k": np.array([r[1] for r in out], np.uint64).view(np.int64),
                                "doc_id": batch["doc_id"].astype("Int64").iloc[rows].array, "th": batch["th"].to_numpy()[rows], "at": batch["at"].to_numpy()[rows],
                                "off": np.array([r[2] for r in out], np.int32), "ctx": pd.Series([r[3] for r in out], dtype=object)})

    return crowded.select("h", "k", "doc_id", "th", "at", "off", "ctx").mapInPandas(deal, _CONTEXTS)


def _group_spans(contexts: Callable[[DataFrame], DataFrame], groups: DataFrame, length: int, gram: int, crowd: int, run: int,
                 steps: tuple[int, ...]) -> DataFrame:
    """Spans of first places in groups (h, m); groups of more than ``crowd`` contexts are split.  ``contexts`` gives those of some groups."""
    big = groups.where(F.col("m") > crowd).select("h") if steps else None
    if big is None or big.isEmpty():
        return _sorted_groups(contexts(groups), length, run)
    big = F.broadcast(big) if big.count() <= 100_000 else big
    out = _sorted_groups(contexts(groups.where(F.col("m") <= crowd)).join(big, "h", "left_anti"), length, run)
    parts = cut(_split(contexts(groups.where(F.col("m") > crowd)).join(big, "h", "left_semi"), steps[0], length, gram))
    # Least places by partial aggregation, not by a window: any number of contexts may share a part.
    least = parts.groupBy("h", "k").agg(F.min(F.struct("doc_id", "at")).alias("least"))
    told = cut(parts.join(least, ["h", "k"]).withColumn("first", F.struct("doc_id", "at") == F.col("least")).drop("least"))
    later = told.where(~F.col("first") & (F.length("ctx") >= length))
    start = F.col("at") - F.col("off")
    out = out.unionByName(later.select("doc_id", "th", F.array(start, start + F.length("ctx")).alias("spans")))
    own = told.where("first").drop("first")
    sizes = cut(own.select("h", "k").distinct().groupBy("h").agg(F.count("*").alias("m")).where("m > 1"))
    inner = lambda some: own.join(some.select("h"), "h", "left_semi")
    return out.unionByName(_group_spans(inner, sizes, length, gram, crowd, run, steps[1:]))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, run: int = RUN, steps: tuple[int, ...] = STEPS,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, th, spans): starts and ends in turn, of repeats in the rows (doc_id, th, text)."""
    spark = docs.sparkSession
    if gram < 8 or gram & gram - 1 or 2 * gram > length:
        raise ValueError("gram must be a power of two, 8 at least and half of length at most")
    known = bit_set(cut(repeated_anchors(docs, length, gram)), max_bits)
    path = shared_folder(spark, "repeat-places")
    # A context has at most one row of each task here, so no window grows with the copies of a text.
    ranked = places(docs, known, length, gram).withColumn("rank", F.rank().over(Window.partitionBy("h", "k").orderBy("doc_id", "at")))
    ranked.write.parquet(path)
    found = spark.read.parquet(path)
    told = found.where("spans is not null").select("doc_id", "th", "spans")
    later = found.where("spans is null and rank > 1").where(F.col("size") >= length)
    start = F.col("at") - F.col("off")
    told = told.unionByName(later.select("doc_id", "th", F.array(start, start + F.col("size")).alias("spans")))
    first = found.where("spans is null and rank = 1").select("h", "doc_id", "at")
    groups = cut(first.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"))
    contexts = lambda some: context_texts(docs, first, some.select("h"), length, gram, max_bits)
    told = told.unionByName(_group_spans(contexts, groups, length, gram, crowd, run, steps))
    return told.groupBy("doc_id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _without_udf():
    """Text and spans to bytes in, bytes removed, removed spans and bytes kept."""
    @F.pandas_udf("n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept binary")
    def without(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, flat in zip(texts, spans, strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            flat = np.empty(0, np.int64) if flat is None else np.asarray(flat, np.int64)
            start, end, _ = _joined(flat[::2], flat[1::2], np.zeros(len(flat) // 2, np.int64))
            own = np.stack([start, end], 1).ravel().tolist()
            edges = [0, *own, len(raw)]
            out.append((len(raw), sum(own[1::2]) - sum(own[::2]), [{"start": a, "end": b} for a, b in zip(own[::2], own[1::2], strict=True)],
                        b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "removed", "kept"])

    return without


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per row: the id, bytes in, bytes removed, the removed spans and the bytes kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    spans = repeated_spans(rows, **limits).withColumnsRenamed({"doc_id": "_doc", "th": "_th"})
    out = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th")), "left")
    return out.select(F.col("doc_id").alias(id_col), _without_udf()("text", "spans").alias("_r")).select(id_col, "_r.*")


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
