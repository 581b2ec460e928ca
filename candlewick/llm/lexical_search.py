"""Ranked lexical search by a dual tree over items and documents.

Documents become sparse vectors over the terms of the items, in Spark; corpus counts
(documents, terms, document frequencies) are sums over all of them.  The items form a
tree whose nodes hold the largest weight of each term below them; every batch of
documents forms a tree whose nodes hold the largest term impact.  The product of two
nodes bounds every score below the pair, so a pair whose bound stays under the weakest
k-th score of its items (or ties with it at no smaller id) is pruned with all it holds.
Remaining leaf pairs are scored exactly.  A first search of a bounded sample gives
k-th scores to start from; they decide only what is pruned, never what is returned.

Items are read in blocks of a bounded number of characters, each searched against all
documents.  A task returns at most ``k`` rows of each item, merged in two steps.

Defined results: null, empty and term-free texts match nothing and do not count as
documents; repeated document rows are documents of their own, with equal scores at the
same id; a null document id comes after all others; rows of equal item id and text are
one item, items that share an id (also a null one) with other text are ranked each; ties go to
the smaller id; whole texts count, whatever their length; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.common import cut, give_back_memory, shared_folder, table, text_blocks, text_slices

TOP, SAMPLE, BATCH, LEAF, ITEM_LEAF, FAN, SALTS = 20, 20_000, 4096, 64, 8, 8, 32
BLOCK_CHARS = 400_000
IMPACT_SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 12, 25
LAST_ID = np.iinfo(np.int64).max


def _term_table() -> bytes:
    """Bytes to themselves, A-Z to lower case, all ASCII but letters and digits to a blank."""
    own = bytearray(range(256))
    for code in range(128):
        own[code] = ord(chr(code).lower()) if chr(code).isalnum() else 32
    return bytes(own)


TERM_TABLE = _term_table()


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_TABLE).split()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, term, tf) of documents with a term: numbers and counts of the vocabulary's terms as int32 bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value
        for batch in batches:
            rows, at = [], 0
            for own in text_slices(batch["text"]):
                for text in own:
                    words = terms(text)
                    found = Counter(w for w in words if w in number)
                    if words:
                        rows.append((batch["doc_id"].iat[at], len(words), np.fromiter(map(number.get, found), np.int32, len(found)).tobytes(),
                                     np.fromiter(found.values(), np.int32, len(found)).tobytes()))
                    at += 1
            yield pd.DataFrame(rows, columns=["doc_id", "n", "term", "tf"]).astype({"doc_id": "Int64", "n": "int64"})
            give_back_memory()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        measure, "doc_id long, n long, term binary, tf binary")


def corpus_counts(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms of all documents, and the document frequency of each of ``size`` terms."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch["term"]), np.int32), minlength=size)
        at = np.flatnonzero(held)
        yield pd.DataFrame({"term": at, "df": held[at]})

    n, total = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for r in found.select("term").mapInPandas(add, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return n, total, df


def term_weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """A term's impact in a document of ``length`` terms: whole numbers, rounded down."""
    norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * n) // max(1, total)
    return (IMPACT_SCALE * tf) // (1000 * tf + SATURATION * norm)


def _parents(leaves: np.ndarray) -> list[np.ndarray]:
    """Node maxima level by level, leaves first, up to one root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append(np.stack([below[k:k + FAN].max(0) for k in range(0, len(below), FAN)]))
    return levels


def item_tree(weights: np.ndarray) -> dict:
    """Items in an order that puts those of one heavy term together, and the nodes' largest weights and term lists."""
    order = np.lexsort((weights.max(1), weights.argmax(1)))
    own = weights[order]
    leaves = np.stack([own[k:k + ITEM_LEAF].max(0) for k in range(0, len(own), ITEM_LEAF)])
    levels = _parents(leaves)
    return {"order": order, "weights": own, "levels": levels, "terms": [[np.flatnonzero(row) for row in level] for level in levels]}


class Search:
    """The best ``top`` documents of each item so far, by score and then smaller id."""

    def __init__(self, tree: dict, n: int, total: int, top: int, floor: tuple[np.ndarray, np.ndarray] | None):
        items = len(tree["order"])
        self.tree, self.n, self.total, self.top = tree, n, total, top
        self.score, self.doc = np.zeros((items, top), np.int64), np.full((items, top), LAST_ID)
        #: A document must beat this score, or meet it with an id that is not larger.
        self.least, self.last = (x.copy() for x in floor) if floor else (np.zeros(items, np.int64), np.full(items, -1, np.int64))
        heaviest = int(tree["weights"].sum(1).max(initial=0)) * (IMPACT_SCALE // 1000)
        self.exact = np.float64 if heaviest < 1 << 53 else np.int64  # whole numbers either way
        self.pairs = self.scored = 0

    def add(self, doc: np.ndarray, length: np.ndarray, term: np.ndarray, tf: np.ndarray, size: np.ndarray) -> None:
        """A batch of documents; ``term`` and ``tf`` of all of them end to end, ``size`` of each."""
        row = np.repeat(np.arange(len(doc)), size)
        impact = impacts(tf.astype(np.int64), length[row], self.n, self.total)
        heavy = np.zeros(len(doc), np.int64)
        order = np.lexsort((impact, row))
        heavy[row[order]] = term[order]  # the term of the largest impact
        place = np.empty(len(doc), np.int64)
        by_term = np.lexsort((length, heavy))
        place[by_term] = np.arange(len(doc))
        doc, at = doc[by_term], place[row]
        order = np.argsort(at, kind="stable")
        at, term, impact = at[order], term[order], impact[order]
        n_leaves = -(-len(doc) // LEAF)
        bounds = np.searchsorted(at, np.arange(n_leaves + 1) * LEAF)
        leaves = np.zeros((n_leaves, self.tree["weights"].shape[1]), self.exact)
        np.maximum.at(leaves, (at // LEAF, term), impact)
        levels = _parents(leaves)
        first_id = [np.minimum.reduceat(doc, np.arange(0, len(doc), LEAF))]
        while len(first_id[-1]) > 1:
            first_id.append(np.minimum.reduceat(first_id[-1], np.arange(0, len(first_id[-1]), FAN)))
        self.batch = (doc, at, term, impact, bounds, levels, first_id)
        tree = self.tree
        stack = [(len(tree["levels"]) - 1, 0, len(levels) - 1, np.zeros(1, np.int64))]
        while stack:
            i_level, i, d_level, d = stack.pop()
            d, bound = self._alive(i_level, i, d_level, d)
            if not len(d):
                continue
            if i_level == 0 and d_level == 0:
                for leaf in d[np.argsort(-bound, kind="stable")]:
                    if len(self._alive(0, i, 0, np.array([leaf]))[0]):
                        self._score(i, int(leaf))
            elif i_level == 0 or d_level > i_level:
                below = (d[:, None] * FAN + np.arange(FAN)).ravel()
                stack.append((i_level, i, d_level - 1, below[below < len(levels[d_level - 1])]))
            else:
                stack += [(i_level - 1, c, d_level, d) for c in range(i * FAN, min((i + 1) * FAN, len(tree["levels"][i_level - 1])))]

    def _alive(self, i_level: int, i: int, d_level: int, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The document nodes whose bound with an item node reaches the weakest k-th score of its items."""
        span = ITEM_LEAF * FAN ** i_level
        least, last = self.least[i * span:(i + 1) * span], self.last[i * span:(i + 1) * span]
        at = self.tree["terms"][i_level][i]
        bound = self.batch[5][d_level][np.ix_(d, at)] @ self.tree["levels"][i_level][i, at].astype(self.exact)
        weakest = least.min()
        ids = last[least == weakest].max()
        self.pairs += len(d)
        keep = (bound > weakest) | ((bound == weakest) & (self.batch[6][d_level][d] <= ids) & (weakest > 0))
        return d[keep], bound[keep]

    def _score(self, i: int, leaf: int) -> None:
        doc, at, term, impact, bounds, _, _ = self.batch
        cols = self.tree["terms"][0][i]
        where = np.full(self.tree["weights"].shape[1], -1, np.int64)
        where[cols] = np.arange(len(cols))
        lo, hi = bounds[leaf], bounds[leaf + 1]
        col = where[term[lo:hi]]
        own = np.zeros((min(LEAF, len(doc) - leaf * LEAF), len(cols)), self.exact)
        own[(at[lo:hi] - leaf * LEAF)[col >= 0], col[col >= 0]] = impact[lo:hi][col >= 0]
        items = slice(i * ITEM_LEAF, (i + 1) * ITEM_LEAF)
        scores = (self.tree["weights"][items][:, cols].astype(self.exact) @ own.T).astype(np.int64)
        ids = doc[leaf * LEAF:leaf * LEAF + len(own)]
        self.scored += 1
        for k, row in enumerate(scores, i * ITEM_LEAF):
            good = (row > self.least[k]) | ((row == self.least[k]) & (ids <= self.last[k]) & (row > 0))
            if good.any():
                score, ident = np.concatenate([self.score[k], row[good]]), np.concatenate([self.doc[k], ids[good]])
                best = np.lexsort((ident, -score))[:self.top]
                self.score[k], self.doc[k] = score[best], ident[best]
                weakest, last = score[best[-1]], ident[best[-1]]
                if weakest > self.least[k] or (weakest == self.least[k] and last < self.last[k]):
                    self.least[k], self.last[k] = weakest, last

    def rows(self) -> pd.DataFrame:
        k, place = np.nonzero(self.score)
        return pd.DataFrame({"item": self.tree["order"][k], "doc_id": self.doc[k, place], "score": self.score[k, place]})


def _search(found: DataFrame, tree: dict, n: int, total: int, top: int, floor) -> DataFrame:
    """(item, doc_id, score): at most ``top`` rows of each item from each task."""
    shared = found.sparkSession.sparkContext.broadcast((tree, floor))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, floor = shared.value
        search = Search(tree, n, total, top, floor)
        for batch in batches:
            for k in range(0, len(batch), BATCH):
                own = batch.iloc[k:k + BATCH]
                size = own["term"].map(len).to_numpy() // 4
                ids = own["doc_id"].astype("Int64").fillna(LAST_ID).to_numpy(np.int64)
                search.add(ids, own["n"].to_numpy(np.int64), np.frombuffer(b"".join(own["term"]), np.int32),
                           np.frombuffer(b"".join(own["tf"]), np.int32), size)
        yield search.rows()
        give_back_memory()

    return found.mapInPandas(run, "item int, doc_id long, score long")


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item with their rank, merged by salt first, so no task gets all rows of an item."""
    order = [F.desc("score"), F.asc("doc_id")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score", F.spark_partition_id()), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    whole = Window.partitionBy("item").orderBy(*order)
    return some.drop("salt", "rank").withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: list[tuple[int | None, str]], id_col: str, text_col: str, top: int, sample: int) -> DataFrame:
    spark = docs.sparkSession
    wanted = [Counter(terms(text)) for _, text in items]
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*wanted)))}
    path = shared_folder(spark, "search-vectors")
    vectors(docs, vocabulary, id_col, text_col).write.parquet(path)
    found = spark.read.parquet(path)
    n, total, df = corpus_counts(found, len(vocabulary))
    weight = term_weights(n, df)
    queries = np.zeros((len(items), len(vocabulary)), np.int64)
    for k, own in enumerate(wanted):
        for t, c in own.items():
            queries[k, vocabulary[t]] = c * weight[vocabulary[t]]
    tree = item_tree(queries)
    some = found.where(F.length("term") > 0)
    chosen = some.where(F.pmod(F.xxhash64("doc_id", "term"), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1, sample / max(1, n))))
    floor = np.zeros(len(items), np.int64), np.full(len(items), -1, np.int64)
    place = np.empty(len(items), np.int64)
    place[tree["order"]] = np.arange(len(items))
    for r in _best(_search(chosen, tree, n, total, top, None), top).where(F.col("rank") == top).collect():
        floor[0][place[r["item"]]], floor[1][place[r["item"]]] = r["score"], r["doc_id"]
    best = _best(_search(some, tree, n, total, top, floor), top)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], "item int, item_id long")
    return best.join(F.broadcast(names), "item").select(  # a block's items, bounded by its characters
        "item_id", "rank", F.when(F.col("doc_id") != int(LAST_ID), F.col("doc_id")).alias("doc_id"), "score")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", top: int = TOP, sample: int = SAMPLE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above zero."""
    out = None
    for block in text_blocks(items, item_id_col, item_text_col, block_chars):
        rows = cut(_search_block(docs, block, id_col, text_col, top, sample))
        out = rows if out is None else out.unionByName(rows)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = r"regexp_extract_all(translate(text, '{}', '{}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_UPPER, _LOWER)
OP11_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, {_TERMS} AS terms FROM documents),
d AS (SELECT row_id, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM t WHERE len(terms) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM d),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
tf AS (SELECT row_id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term, big_n),
s AS (SELECT i.item_id, d.row_id, d.doc_id,
    CAST(sum(i.times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (100 - 25 + (25 * d.n * big_n) // big_l)))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN d USING (row_id), c GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {TOP}
"""
