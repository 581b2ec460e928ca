import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from candlewick.llm import lexical_search as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=20):
    """Every document of every item, scored one by one."""
    held = [(i, WORD.findall((t or "").translate(LOWER))) for i, t in docs]
    held = [(i, w, Counter(w)) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w, _ in held)
    df = Counter(t for _, _, c in held for t in c)
    out = []
    for item, text in sorted(set((i, t) for i, t in items if t is not None), key=str):
        ranked = []
        for i, w, c in held:
            m = 100 - 25 + (25 * len(w) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in WORD.findall(text.translate(LOWER)) if c[t])
            ranked += [(-s, i is None, i or 0)] if s > 0 else []
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def corpus(n, seed, words=400):
    rng = np.random.default_rng(seed)
    vocab = [f"w{k}" for k in range(words)] + ["ÄÖ", "été", "Zq9", "日本"]
    p = 1 / np.arange(3, len(vocab) + 3)
    return [" ".join(rng.choice(vocab, rng.integers(1, 120), p=p / p.sum())) for _ in range(n)]


def test_equals_brute_force_and_sql(spark):
    texts = corpus(700, 1)
    docs = [(k * 3, t) for k, t in enumerate(texts)] + [(9000 + k, texts[5]) for k in range(200)]  # copies: ties at one score
    items = [(k, t[:200]) for k, t in enumerate(corpus(40, 2))] + [(50, texts[5]), (51, "nothing here matches"), (52, "w3 w3 w3 W3")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    got = rows(L.ranked_search(d, i, sample=100))
    assert got == brute(docs, items)
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    con.register("benchmark", i.toPandas())
    assert got == sorted(con.execute(L.OP11_SQL).fetchall(), key=str)


def test_several_item_blocks_and_no_sample(spark):
    docs, items = [(k, t) for k, t in enumerate(corpus(150, 3))], [(k, t) for k, t in enumerate(corpus(30, 4))]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(L.ranked_search(d, i, sample=1, block_chars=2500, top=5)) == brute(docs, items, 5)


def test_nulls_repeats_ties_extra_columns(spark):
    long = "needle " + "hay stack " * 40_000
    docs = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "a b c"), (None, "a"), (4, "...!"), (5, long), (6, "A-B_c x"), (-7, "c b a")]
    items = [(1, "a c"), (1, "a c"), (None, "b"), (1, "needle"), (2, None), (3, ""), (4, "a")]
    d = spark.createDataFrame([(*r, 0, 1, 2.0) for r in docs], "doc_id long, text string, score int, rank int, item_id double")
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    assert rows(L.ranked_search(d, i)) == brute(docs, items)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    out = L.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_bounds_prune_batches_and_lose_nothing():
    rng = np.random.default_rng(0)
    weights = np.zeros((64, 300), np.int64)
    for k in range(64):
        weights[k, k % 15 * 20 + rng.choice(20, 6, replace=False)] = rng.integers(100, 9000, 6)
    tree = L.item_tree(weights)
    search = L.Search(tree, 4000, 4000 * 20, 5, None)
    docs, sizes, term, tf = np.arange(4000), [], [], []
    for d in docs:  # fifteen subjects with terms of their own
        own = d % 15 * 20 + rng.choice(20, 12, replace=False)
        sizes.append(12), term.append(own), tf.append(rng.integers(1, 9, 12))
    length = rng.integers(15, 400, 4000)
    for k in range(0, 4000, 1000):
        s = slice(k, k + 1000)
        search.add(docs[s], length[s], np.concatenate(term[s]), np.concatenate(tf[s]), np.array(sizes[s]))
    assert search.scored < 0.3 * (4000 / L.LEAF) * (64 / L.ITEM_LEAF)
    got = search.rows()
    for item in range(64):
        score = [int(sum(weights[item, t] * L.impacts(f, length[d], 4000, 80_000) for t, f in zip(term[d], tf[d], strict=True))) for d in docs]
        want = sorted(((-s, d) for d, s in enumerate(score) if s > 0))[:5]
        own = got[got["item"] == item].sort_values(["score", "doc_id"], ascending=[False, True])
        assert list(zip(-own["score"], own["doc_id"], strict=True)) == want


def test_whole_numbers_beyond_doubles():
    weights = np.array([[1 << 40, 3]], np.int64)
    search = L.Search(L.item_tree(weights), 10, 100, 2, None)
    assert search.exact is np.int64
    search.add(np.array([7, 8]), np.array([10, 10]), np.array([0, 0, 1]), np.array([5, 5, 1]), np.array([1, 2]))
    f, g = L.impacts(np.array([5, 1]), np.array([10, 10]), 10, 100)
    assert sorted(search.rows()["score"]) == [(1 << 40) * int(f), (1 << 40) * int(f) + 3 * int(g)]
