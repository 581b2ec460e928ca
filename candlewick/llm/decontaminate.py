"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared lower-cased, with every run of anything but letters and digits
as one blank.  A benchmark item is cut into overlapping windows; a document holds
a window if some region of it is within the window's edit budget.  If so, region
and window share at least m + 1 - q (e + 1) q-grams (m: window length, e: budget)
whose diagonals lie within e of each other, so they fall into one of two rows of
overlapping diagonal bands.  Shared q-grams are counted by document, window and
band; bands that reach the bound are verified by alignment within the band.  An excerpt of
``window`` characters that is copied to the letter is a run of q-grams on one diagonal, so it is
found wherever in the item it starts; with edits, a passage must hold one of the windows.

Many items may share a phrase.  Equal windows are one window; q-grams that many windows have are
counted once for all windows that have the same ones at the same places; what is
left for such windows is aligned from the end that they do not share, and given up
as soon as the budget is spent.  Counting goes in chunks of a bounded number of hits.

The benchmark is read in blocks of a bounded number of characters; each block goes
over all documents, so a benchmark of any size is handled whole.

Defined results: null and empty texts hold nothing; items of under ``shortest``
characters after normalising (also null ones) are no evidence and match nothing;
items of equal id and text are one item, others that share an id, also a null one, are reported each;
a passage that crosses two documents is in neither; very long texts are searched whole; rows of equal id
and text are reported each; other columns are not read, and ``clean`` hands them through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import give_back_memory, map_codes, table, text_blocks, text_slices

Q, WINDOW, STEP, RATE, SHORTEST, BLOCK_CHARS = 8, 100, 50, 0.08, 24, 2_000_000
#: A q-gram that more windows have is counted by class of windows; hits counted at a time.
COMMON, HITS = 16, 1_000_000
BLANK, BREAK = 32, 1
_BITS = 22


def _letter(code: int) -> int:
    """A letter or digit in lower case, or a blank."""
    c = chr(code)
    low = c.lower()
    return (ord(low) if len(low) == 1 else code) if c.isalnum() else BLANK


def _letters() -> np.ndarray:
    """Letters of the first code points; ``map_codes`` asks for those beyond."""
    return np.array([_letter(code) for code in range(0x3000)], np.uint32)


def normalise(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts with a break after each, the original place of each code, and where each text starts there."""
    raw = "\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, "<u4")
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    own = map_codes(codes, letters, _letter)
    own[ends - 1] = BREAK
    blank = own == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1] & (own[:-1] != BREAK)  # the first blank of a run, but none at a text's start
    place = np.flatnonzero(keep)
    return own[place], place, np.concatenate([[0], ends[:-1]])


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of all q-grams (q a power of two), by doubling."""
    h, k, base = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1, 0xD6E8FEB86659FD93
    h ^= h >> np.uint64(31)
    while k < q:
        h = h[:len(h) - k] * np.uint64(base) + h[k:] if len(h) > k else h[:0]
        base, k = base * base % (1 << 64) | 1, 2 * k
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def build_index(items: list[tuple[int | None, str]], q: int = Q, window: int = WINDOW, step: int = STEP, rate: float = RATE,
                shortest: int = SHORTEST) -> dict | None:
    """Distinct windows of the items, their budgets and bounds, the q-gram table, and the items' own codes for verbatim runs."""
    letters, texts, number, held = _letters(), [], [], {}
    for i, (_, text) in enumerate(items):
        codes = normalise([text or ""], letters)[0]
        codes = codes[:-1] if len(codes) and codes[-1] == BREAK else codes
        codes = codes[:-1] if len(codes) and codes[-1] == BLANK else codes
        if len(codes) < max(shortest, q):
            continue
        for start in sorted({*range(0, max(1, len(codes) - window), step), max(0, len(codes) - window)}):
            held.setdefault(codes[start:start + window].tobytes(), []).append(i)
        texts.append(codes)
        number.append(i)
    if not held:
        return None
    parts = [np.frombuffer(p, np.uint32) for p in held]
    size = np.array([len(p) for p in parts], np.int64)
    budget = np.minimum((rate * size).astype(np.int64), size // q - 1)  # a bound of one q-gram at least
    hashes = [gram_hashes(p, q) for p in parts]
    flat = np.concatenate(hashes)
    part = np.repeat(np.arange(len(parts)), [len(h) for h in hashes])
    offset = np.concatenate([np.arange(len(h)) for h in hashes])
    _, gram, times = np.unique(flat, return_inverse=True, return_counts=True)
    common = times[gram] > COMMON
    # Windows with the same common q-grams at the same places are a class; units are windows and, after them, classes.
    classes: dict[bytes, int] = {}
    of_class, unit, keep = np.full(len(parts), -1, np.int64), part.copy(), ~common
    where = np.searchsorted(part, np.arange(len(parts) + 1))
    for p in range(len(parts)):
        own = np.flatnonzero(common[where[p]:where[p + 1]]) + where[p]
        if len(own):
            key = size[p].tobytes() + gram[own].tobytes() + offset[own].tobytes()
            keep[own] = key not in classes  # a class's entries come from its first window
            of_class[p] = classes.setdefault(key, len(classes))
            unit[own] = len(parts) + of_class[p]
    flat, unit, offset_kept = flat[keep], unit[keep], offset[keep]
    order = np.argsort(flat, kind="stable")
    grams, at = np.unique(flat[order], return_index=True)
    seen = np.zeros(1 << _BITS, bool)
    seen[(grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    padded = np.zeros((len(parts), window), np.uint32)
    for k, p in enumerate(parts):
        padded[k, :len(p)] = p
    shared = np.array([common[where[p]:where[p + 1]] @ np.arange(where[p + 1] - where[p]) * 2 < common[where[p]:where[p + 1]].sum() * (where[p + 1] - where[p])
                       for p in range(len(parts))])  # its common q-grams stand in its first half: aligned from its end
    members = np.argsort(of_class, kind="stable")
    members = members[of_class[members] >= 0]
    firsts = np.searchsorted(of_class[members], np.arange(len(classes) + 1))
    lead = np.array([members[k] for k in firsts[:-1]], np.int64)
    unit_budget = np.concatenate([budget, budget[lead]]) if len(lead) else budget
    runs = [gram_hashes(t, q) for t in texts if len(t) >= window]
    run_of = [i for i, t in zip(number, texts, strict=True) if len(t) >= window]
    return {"q": q, "window": window, "items": [i for i, _ in items], "held": list(held.values()), "size": size, "budget": budget, "unit_budget": unit_budget,
            "least": size + 1 - q * (budget + 1), "grams": grams, "first": np.append(at, len(flat)), "unit": unit[order], "offset": offset_kept[order],
            "seen": seen, "codes": padded, "of_class": of_class, "members": members, "firsts": firsts, "from_end": shared, **_run_index(runs, run_of, window, q)}


def _run_index(hashes: list[np.ndarray], numbers: list[int], window: int, q: int) -> dict:
    """Every stretch of ``window`` characters of the items by a hash of its first, middle and last q-grams, to spot verbatim excerpts."""
    marks = (0, (window - q) // 2, window - q)
    own = [sum((h[m:len(h) - (window - q) + m] * np.uint64(2 * i + 3) for i, m in enumerate(marks)), np.uint64(0)) for h in hashes]
    flat = np.concatenate(own) if own else np.empty(0, np.uint64)
    item = np.repeat(np.array(numbers, np.int64), [len(o) for o in own])
    at = np.concatenate([np.arange(len(o)) for o in own]) if own else np.empty(0, np.int64)
    order = np.lexsort((at, item, flat))
    return {"marks": marks, "stretch": flat[order], "stretch_item": item[order], "stretch_at": at[order], "hashes": dict(zip(numbers, hashes, strict=True))}


def _verbatim(hits: np.ndarray, hashes: np.ndarray, starts: np.ndarray, place: np.ndarray, index: dict) -> dict[tuple[int, int], int]:
    """(text, item) to the first place of a stretch of ``window`` characters that both have to the letter."""
    out: dict[tuple[int, int], int] = {}
    width = index["window"] - index["q"]
    if not len(index["stretch"]) or len(hashes) <= width or not len(hits):
        return out
    known = np.zeros(len(hashes), bool)
    known[hits] = True
    at = np.flatnonzero(np.logical_and.reduce([known[m:len(hashes) - width + m] for m in index["marks"]]))
    own = sum((hashes[at + m] * np.uint64(2 * i + 3) for i, m in enumerate(index["marks"])), np.uint64(0))
    lo = np.searchsorted(index["stretch"], own)
    same = index["stretch"][np.minimum(lo, len(index["stretch"]) - 1)] == own
    hits, own, lo = at[same], own[same], lo[same]
    text = np.searchsorted(starts, place[hits], "right") - 1
    for hit, t, k, h in zip(hits.tolist(), text.tolist(), lo.tolist(), own, strict=True):
        while k < len(index["stretch"]) and index["stretch"][k] == h:
            item, at = int(index["stretch_item"][k]), int(index["stretch_at"][k])
            k += 1
            if (t, item) not in out and (index["hashes"][item][at:at + width + 1] == hashes[hit:hit + width + 1]).all():
                out[t, item] = int(place[hit] - starts[t])
    return out


def _align(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: np.ndarray, part: np.ndarray, index: dict) -> np.ndarray:
    """Least edits of each candidate window to a region whose diagonals lie in its band; all of one window size, budget and
    direction.  Windows that spend more than their budget on the way are given up, at one edit more than it."""
    m, e, back = int(index["size"][part[0]]), int(index["budget"][part[0]]), bool(index["from_end"][part[0]])
    width = 2 * (e + 1) + 2 * e + 1
    at = low[:, None] - e + np.arange(width + m)
    own = np.where((at >= starts[:, None]) & (at < ends[:, None]), codes[np.clip(at, 0, len(codes) - 1)], 0)
    wanted = index["codes"][part, :m]
    if back:
        own, wanted = own[:, width + m - 2::-1], wanted[:, ::-1]
    cost, steps = np.zeros((len(part), width), np.int16), np.arange(width, dtype=np.int16)
    live, out = np.arange(len(part)), np.full(len(part), e + 1, np.int64)
    for i in range(m):
        new = cost + (own[:, i:i + width] != wanted[:, i][:, None])
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(new - steps, axis=1) + steps
        if i % 4 == 3 and i + 1 < m:
            good = cost.min(1) <= e
            if good.mean() < 0.8:
                cost, own, wanted, live = cost[good], own[good], wanted[good], live[good]
                if not len(live):
                    return out
    out[live] = cost.min(1)
    return out


def _counted(hit: np.ndarray, text: np.ndarray, gram: np.ndarray, index: dict) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, text, window, band) of the bands whose shared q-grams reach the bound, for the hits of some whole texts."""
    n = len(index["size"])
    times = index["first"][gram + 1] - index["first"][gram]
    entry = np.repeat(index["first"][gram] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    unit = index["unit"][entry]
    diagonal = np.repeat(hit, times) - index["offset"][entry] + index["window"]  # never negative
    span, own = index["unit_budget"][unit] + 1, np.repeat(text, times)
    units = n + len(index["firsts"]) - 1
    for row in (0, 1):  # two rows of bands, half a band apart
        band = (diagonal + row * span) // (2 * span)
        key, count = np.unique((own * units + unit) << 32 | band, return_counts=True)
        t, u, b = (key >> 32) // units, (key >> 32) % units, key & 0xFFFFFFFF
        whole = u >= n
        windows, n_own = np.flatnonzero(~whole), count[~whole]
        # A window's q-grams are its own and those of its class; a class that reaches the bound alone brings all its windows.
        total = n_own.copy()
        cls = index["of_class"][u[windows]]
        if whole.any():
            at = np.searchsorted(key, (t[windows] * units + n + cls) << 32 | b[windows])
            at = np.minimum(at, len(key) - 1)
            total += np.where((cls >= 0) & (key[at] == (t[windows] * units + n + cls) << 32 | b[windows]), count[at], 0)
        good = total >= index["least"][u[windows]]
        found = [(t[windows][good], u[windows][good], b[windows][good])]
        if whole.any():
            c, lead = u[whole] - n, index["members"][index["firsts"][u[whole] - n]]
            alone = count[whole] >= index["least"][lead]
            ct, c, cb = t[whole][alone], c[alone], b[whole][alone]
            many = index["firsts"][c + 1] - index["firsts"][c]
            member = index["members"][np.repeat(index["firsts"][c] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            found.append((np.repeat(ct, many), member, np.repeat(cb, many)))
        t, w, b = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = np.unique(np.stack([t, w, b]), axis=1) if len(t) else np.empty((3, 0), np.int64)
        yield row, keep[0], keep[1], keep[2]


def find_regions(texts: list[str], index: dict, letters: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text, item number, window, edits, original offset) of every verified band, and of verbatim excerpts under window -1."""
    codes, place, starts = normalise(texts, letters)
    hashes = gram_hashes(codes, index["q"])
    hits = np.flatnonzero(index["seen"][(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
    gram = np.minimum(np.searchsorted(index["grams"], hashes[hits]), len(index["grams"]) - 1)
    same = index["grams"][gram] == hashes[hits]
    hits, gram = hits[same], gram[same]
    out = [(t, item, -1, 0, at) for (t, item), at in _verbatim(hits, hashes, starts, place, index).items()]
    if not len(hits):
        return out
    text = np.searchsorted(starts, place[hits], "right") - 1
    first = np.searchsorted(place, starts)
    last = np.append(first[1:], len(codes)) - 1  # without the break
    entries = np.cumsum(index["first"][gram + 1] - index["first"][gram])
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]) + 1, len(text))  # chunks are whole texts
    a = 0
    while a < len(hits):
        most = entries[a - 1] + HITS if a else HITS
        b = int(ends[max(np.searchsorted(entries[ends - 1], most, "right") - 1, np.searchsorted(ends, a, "right"))])
        for row, t, part, band in _counted(hits[a:b], text[a:b], gram[a:b], index):
            span = index["budget"][part] + 1
            low = band * 2 * span - row * span - index["window"]
            kinds = np.stack([index["size"][part], index["budget"][part], index["from_end"][part]])
            for kind in np.unique(kinds, axis=1).T:
                mine = np.flatnonzero((kinds == kind[:, None]).all(0))
                for k in range(0, len(mine), 20_000):
                    own = mine[k:k + 20_000]
                    edits = _align(codes, first[t[own]], last[t[own]], low[own], part[own], index)
                    for i in np.flatnonzero(edits <= kind[1]):
                        at = int(place[np.clip(low[own[i]], first[t[own[i]]], last[t[own[i]]])] - starts[t[own[i]]])
                        out += [(int(t[own[i]]), item, int(part[own[i]]), int(edits[i]), at) for item in index["held"][part[own[i]]]]
        a = b
    return out


def regions_udf(spark: SparkSession, index: dict | None):
    """Text to its items: array of (item_id, windows found, least edits, offset of the first)."""
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf("array<struct<item_id:long,windows:int,edits:int,offset:long>>")
    def regions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, letters = shared.value, _letters()
        for texts in batches:
            out = []
            for own in text_slices(texts, 1_000_000) if index else ():
                by_text: list[dict] = [{} for _ in own]
                for t, item, part, edits, offset in find_regions(own, index, letters):
                    told = by_text[t].setdefault(item, [set(), edits, offset])
                    told[0].add(part)
                    told[1:] = min(told[1], edits), min(told[2], offset)
                out += [[{"item_id": index["items"][i], "windows": max(1, len(w - {-1})), "edits": e, "offset": o} for i, (w, e, o) in sorted(x.items())]
                        for x in by_text]
            yield pd.Series(out if index else [[] for _ in texts])
            give_back_memory()

    return regions


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """(id, item_id, windows, edits, offset) per document and item it holds; clean documents have no row."""
    spark, out = docs.sparkSession, None
    for items in text_blocks(benchmark, "item_id", "text", limits.pop("block_chars", BLOCK_CHARS)):
        found = regions_udf(spark, build_index(items, **limits))(F.col(text_col))
        rows = docs.select(F.col(id_col), F.explode(found).alias("_r")).select(id_col, "_r.*")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = docs.select(F.col(id_col), *[F.lit(0).cast(t).alias(c) for c, t in
                          (("item_id", "long"), ("windows", "int"), ("edits", "int"), ("offset", "long"))]).where(F.lit(False))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows that hold no passage of the benchmark."""
    for items in text_blocks(benchmark, "item_id", "text", BLOCK_CHARS):
        docs = docs.where(F.size(regions_udf(docs.sparkSession, build_index(items, **limits))(F.col(text_col))) == 0)
    return docs


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
