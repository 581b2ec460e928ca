"""Language identification by a linear-chain conditional random field over words.

A word's emission score for each language is a sum of learned weights of its
prefixes, suffixes, character n-grams and membership in the languages' lexicons.
Learned transitions link the words of a text, so a code-switched text is labelled
word by word; the marginals come from forward-backward over the whole text, and
the text's language is the one with the largest mean marginal over the words that
have a letter.

Forward-backward runs over blocks of words: each block's transfer matrix first,
then the messages from block to block, then the words within all blocks at once.
It gives the marginals of one chain over the text, for texts of any length.

Training takes about ``per_lang`` labelled rows of each language, chosen by a hash among those
of at most ``longest`` characters, and reads them whole; a language that has only longer rows gives its
shortest one.  Spans of different languages are put one after another to learn transitions.

Defined results: null texts and texts without a letter are ``und`` with score 0; with no
labelled row that has a letter every text is ``und``; ties go to the first language in text order; repeated rows
are predicted alike and count each in training; any number of languages and any length of text is taken
whole; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import LONG_WORD, give_back_memory, held_out, table, text_slices, worker_memo

PER_LANG, LONGEST_ROW = 250, 20_000
BUCKETS, BLOCK, LEXICON = 1 << 16, 32, 300


def core(word: str) -> str:
    """A lower-cased word without what stands around its first and last letter; empty if it has no letter."""
    if word.isalpha():
        return word
    bare = word.strip(".,;:!?'\"()#$%&*|-")
    if bare.isalpha():
        return bare
    at = [i for i, c in enumerate(word) if c.isalpha()]
    return word[at[0]:at[-1] + 1] if at else ""


def features(words: list[str], lexicons: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature number) pairs: hashed prefixes, suffixes and n-grams of marked words, and lexicon entries.

    Words without a character have no feature.
    """
    at = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)))
    own = [words[i] for i in at]
    if not own:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer("".join(f"<{w}>" for w in own).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, own), np.int64, len(own)) + 2
    ends = np.cumsum(sizes)
    starts, word_of = ends - sizes, np.repeat(np.arange(len(own)), sizes)
    number, bucket = [], []

    def add(which: np.ndarray, parts: list[np.ndarray], kind: int) -> None:
        h = np.full(len(which), kind, np.uint64)
        for part in parts:
            h = (h + part + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        number.append(which)
        bucket.append((h >> np.uint64(40)).astype(np.int64) % BUCKETS)

    for n in (2, 3):
        inside = np.flatnonzero(np.arange(len(codes)) + n <= ends[word_of])
        add(word_of[inside], [codes[inside + j] for j in range(n)], n)
    for k in (1, 2, 3, 4):
        long = np.flatnonzero(sizes >= k + 2)
        add(long, [codes[starts[long] + 1 + j] for j in range(k)], 10 + k)
        add(long, [codes[ends[long] - 2 - j] for j in range(k)], 20 + k)
    held = [(i, k) for i, w in enumerate(own) for k in lexicons.get(w, ())]
    number.append(np.array([i for i, _ in held], np.int64))
    bucket.append(np.array([BUCKETS + k for _, k in held], np.int64))
    return at[np.concatenate(number)], np.concatenate(bucket)


def _scores(number: np.ndarray, bucket: np.ndarray, n_words: int, weights: np.ndarray) -> np.ndarray:
    """A row of language scores per word; zeros for a word without features."""
    norm = 1 / np.sqrt(np.maximum(np.bincount(number, minlength=n_words), 1))
    return np.stack([np.bincount(number, weights[bucket, k], n_words) for k in range(weights.shape[1])], 1) * norm[:, None]


def chain_marginals(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Marginals of chains laid end to end; ``e`` has a row of potentials per word, ``lengths`` the words of each chain.

    A chain starts from the uniform distribution, taken through ``trans`` once.
    """
    k, lengths = trans.shape[0], np.asarray(lengths, np.int64)
    blocks = -(-lengths // BLOCK)
    first_block, first_word = np.cumsum(blocks) - blocks, np.cumsum(lengths) - lengths
    total = int(blocks.sum())
    # Words after a chain's end have potentials that leave every backward message as it is.
    at = np.arange(lengths.sum()) - np.repeat(first_word - first_block * BLOCK, lengths)
    pot = np.tile(np.linalg.solve(trans, np.ones(k)), (total * BLOCK, 1))
    pot[at] = e
    pot = np.ascontiguousarray(pot.reshape(total, BLOCK, k).transpose(1, 0, 2))
    carry = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(BLOCK):
        carry = (carry.reshape(-1, k) @ trans).reshape(total, k, k) * pot[t][:, None, :]
        if t % 8 == 7:
            carry /= np.abs(carry).max((1, 2), keepdims=True)
    ahead, behind = np.full((total, k), 1.0 / k), np.ones((total, k))
    order = np.argsort(-blocks, kind="stable")
    live = np.searchsorted(-blocks[order], -np.arange(1, blocks.max(initial=0) + 1), "right")
    for b in range(1, len(live)):  # chains with more than b blocks
        i = first_block[order[:live[b]]] + b
        m = np.matmul(ahead[i - 1][:, None, :], carry[i - 1])[:, 0]
        ahead[i] = m / m.sum(1, keepdims=True)
    for b in range(len(live) - 1, 0, -1):
        i = first_block[order[:live[b]]] + b
        m = np.matmul(carry[i], behind[i][:, :, None])[:, :, 0]
        behind[i - 1] = m / m.sum(1, keepdims=True)
    forward = np.empty((BLOCK, total, k))
    for t in range(BLOCK):
        ahead = (ahead @ trans) * pot[t]
        ahead /= np.abs(ahead).sum(1, keepdims=True)
        forward[t] = ahead
    for t in range(BLOCK - 1, -1, -1):
        forward[t] *= behind
        behind = (behind * pot[t]) @ trans.T
        behind /= np.abs(behind).sum(1, keepdims=True)
    gamma = forward.transpose(1, 0, 2).reshape(-1, k)[at]
    return gamma / gamma.sum(1, keepdims=True)


def _sequences(rows: list[tuple[str, str]], langs: list[str], length: int, rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Words and labels of training chains of equal length: the rows' words in spans, languages mixed."""
    spans = []
    for lang, text in rows:
        words = [w for w in map(core, text.lower().split()) if w]
        k = 0
        while k < len(words):
            n = int(rng.integers(4, max(5, 2 * length)))
            spans.append((langs.index(lang), words[k:k + n]))
            k += n
    spans = [spans[i] for i in rng.permutation(len(spans))]
    words = [w for _, own in spans for w in own]
    label = np.array([lang for lang, own in spans for _ in own], np.int64)
    short = -len(words) % length  # the last chain goes on with the first words
    return words + words[:short], np.concatenate([label, label[:short]])


def train(rows: list[tuple[str, str]], length: int = 40, rounds: int = 60, rate: float = 0.3, decay: float = 1e-6) -> dict | None:
    """Weights and transitions that maximise the conditional likelihood of (language, text) rows."""
    rows = sorted(rows)
    langs = sorted({lang for lang, _ in rows})
    counts = {lang: Counter() for lang in langs}
    for lang, text in rows:
        counts[lang].update(w for w in map(core, text.lower().split()) if w)
    lexicons: dict[str, tuple[int, ...]] = {}
    for k, lang in enumerate(langs):
        for w, _ in sorted(counts[lang].items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicons[w] = (*lexicons.get(w, ()), k)
    length = min(length, sum(c.total() for c in counts.values()))
    if not length:
        return None
    words, label = _sequences(rows, langs, length, np.random.default_rng(0))
    n = len(langs)
    types = sorted(set(words))
    number, bucket = features(types, lexicons)
    norm = 1 / np.sqrt(np.maximum(np.bincount(number, minlength=len(types)), 1))[:, None]
    place = {w: i for i, w in enumerate(types)}
    at = np.array([place[w] for w in words]).reshape(-1, length)
    gold, chains = label.reshape(-1, length), len(words) // length
    weights, link = np.zeros((BUCKETS + n, n)), np.zeros((n, n))
    moments = [np.zeros_like(x) for x in (weights, weights, link, link)]
    pairs = np.zeros((n, n))
    np.add.at(pairs, (gold[:, :-1], gold[:, 1:]), 1)
    for step in range(1, rounds + 1):
        score = _scores(number, bucket, len(types), weights)
        pot, trans = np.exp(score[at] - score[at].max(2, keepdims=True)), np.exp(link)
        forward, back = np.empty((length, chains, n)), np.ones((chains, n))
        now = np.full((chains, n), 1.0 / n)
        for t in range(length):
            now = (now @ trans if t else now) * pot[:, t]
            now /= now.sum(1, keepdims=True)
            forward[t] = now
        error, expected = np.empty((chains, length, n)), np.zeros((n, n))
        for t in range(length - 1, -1, -1):
            gamma = forward[t] * back
            gamma /= gamma.sum(1, keepdims=True)
            gamma[np.arange(chains), gold[:, t]] -= 1
            error[:, t] = gamma
            if t:
                ahead = back * pot[:, t]
                joint = forward[t - 1][:, :, None] * trans * ahead[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                back = ahead @ trans.T
                back /= back.sum(1, keepdims=True)
        grad = np.stack([np.bincount(at.ravel(), error[:, :, k].ravel(), len(types)) for k in range(n)], 1)
        spread = (grad * norm)[number]
        slope = np.stack([np.bincount(bucket, spread[:, k], BUCKETS + n) for k in range(n)], 1) / len(words) + decay * weights
        for x, g, m, v in ((weights, slope, moments[0], moments[1]), (link, (expected - pairs) / len(words), moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
    return {"langs": langs, "lexicons": lexicons, "weights": weights, "trans": np.exp(link - link.max()),
            "key": zlib.crc32(weights.tobytes())}


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           per_lang: int = PER_LANG, longest: int = LONGEST_ROW) -> list[tuple[str, str]]:
    """The labelled training rows, whole: about ``per_lang`` of a language, by hash (the documented bound)."""
    told = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.lit("sample"), F.col(id_col)).alias("draw"))
    told = told.where("lang is not null and text is not null")
    sizes = told.groupBy("lang").agg(F.sum(F.when(F.length("text") <= longest, 1).otherwise(0)).alias("n"), F.min_by("text", F.length("text")).alias("least"))
    sizes = sizes.select("lang", "n", F.when(F.col("n") == 0, F.col("least")).alias("least")).collect()
    chances = [F.lit(x) for r in sizes if r["n"] for x in (r["lang"], min(1.0, per_lang / r["n"]))]
    out = [(r["lang"], r["least"]) for r in sizes if not r["n"]]
    if chances:
        chosen = F.pmod("draw", F.lit(1_000_000)) < F.element_at(F.create_map(*chances), F.col("lang")) * 1_000_000
        out += [(r["lang"], r["text"]) for r in told.where((F.length("text") <= longest) & chosen).select("lang", "text").collect()]
    return out


def predict_udf(spark: SparkSession, model: dict | None):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            parts = [_predict(own, model) for own in text_slices(texts)] if model else []
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": [0.0] * len(texts)})
            give_back_memory()

    def _predict(own: list[str], model: dict) -> pd.DataFrame:
        k = len(model["langs"])
        memo = worker_memo(f"languages:{model['key']}")  # word to row number in the table of emissions
        held = worker_memo(f"emissions:{model['key']}", 1 << 30)
        if not memo:
            held["e"], held["has"] = np.empty((0, k), np.float32), np.empty(0, bool)
        words = [text.lower().split() for text in own]
        new = sorted(set().union(*words).difference(memo))
        cores = [core(w) for w in new]
        score = _scores(*features(cores, model["lexicons"]), len(cores), model["weights"])
        n = len(held["e"])
        held["e"] = np.concatenate([held["e"], np.exp(score - score.max(1, keepdims=True)).astype(np.float32)])
        held["has"] = np.concatenate([held["has"], np.array([bool(c) for c in cores], bool)])
        memo.update(zip(new, range(n, n + len(new)), strict=True))
        lengths = np.array([len(w) for w in words], np.int64)
        at = np.fromiter((memo[w] for own_words in words for w in own_words), np.int64, int(lengths.sum()))
        for w in new:
            if len(w) > LONG_WORD:
                del memo[w]
        has = held["has"][at]
        mean, full = np.zeros((len(own), k)), np.flatnonzero(lengths)
        if len(full):
            gamma = chain_marginals(held["e"][at], lengths[full], model["trans"]) * has[:, None]
            starts = np.cumsum(lengths[full]) - lengths[full]
            told = np.add.reduceat(has, starts, dtype=np.int64)
            mean[full] = np.add.reduceat(gamma, starts, axis=0) / np.maximum(told, 1)[:, None]
        best = mean.argmax(1)
        top = np.clip(mean[np.arange(len(own)), best], 0.0, 1.0)
        return pd.DataFrame({"lang_pred": [model["langs"][b] if s > 0 else "und" for b, s in zip(best, top, strict=True)], "score": top})

    return predict


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out_of = held_out(F.col("doc_id"), 3, 1)
    model = train(sample(docs.where(~out_of)))
    found = docs.select("doc_id", out_of.alias("held_out"), predict_udf(spark, model)(F.col("text")).alias("_p"))
    return found.select("doc_id", "held_out", "_p.*")
