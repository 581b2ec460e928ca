import random
import re

import numpy as np
import pytest
import xxhash

from candlewick.llm import simhash as S
from candlewick.llm.components import connected_components


def fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(links):
    up = {}

    def root(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {a: root(a) for a in up}


def test_fingerprints_against_brute_force(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "One", "One TWO", "Été ÉTÉ a b c d", "a b c d e f g " * 3000, "x y z w"]
    rng = random.Random(1)
    texts += [" ".join(rng.choices("Aa bB cc Dd é ß".split(), k=rng.randint(1, 30))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["fp"] for r in df.select("doc_id", S.fingerprint_udf()("text").alias("fp")).collect()}
    assert [got[i] % (1 << 64) for i in range(len(texts))] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("hot", [2048, 3])
def test_links_join_up_the_same_groups_as_all_pairs(spark, hot):
    rng = random.Random(9)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:20]:
        for _ in range(8):
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                p ^= 1 << bit
            prints.add(p)
    one = rng.getrandbits(32)  # a crowded half
    prints |= {one << 32 | (0xABCD ^ 1 << rng.randrange(32) ^ 1 << rng.randrange(32)) for _ in range(25)}
    prints |= {(one ^ 1) << 32 | (0xABCD ^ 1 << rng.randrange(32)) for _ in range(10)}
    signed = sorted(int(np.uint64(p).astype(np.int64)) for p in prints)
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [(r["a"], r["b"]) for r in S.near_links(df, hot).collect()]
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % (1 << 64)).bit_count() <= 3]
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 3 for a, b in links)
    assert closure(links) == closure(near)


def test_components_against_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    want = closure([x for x in links if x[0] != x[1]])
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clusters_keep_one_and_edge_cases(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(7, text, "a"), (3, text, "b"), (3, text, "b"), (None, text, "c"), (9, None, "d"), (8, "", "e"), (20, "other words here", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in S.cluster(df).collect()), key=str)
    assert got == sorted([(7, 3), (3, 3), (3, 3), (None, 3), (9, 8), (8, 8), (20, 20)], key=str)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 8, 20]
    assert S.keep_one(df.limit(0)).count() == 0 and S.cluster(df.limit(0)).count() == 0
    assert S.keep_one(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")).count() == 1
