import hashlib

import numpy as np
import pytest

from candlewick.llm import suffix_dedup as S


def brute(docs, length):
    """(doc_id, bytes, removed, spans, digest) by a table of the first place of every string of ``length`` bytes."""
    order = lambda i: (i is not None, i or 0)
    first = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            first[w] = min(first.get(w, (*order(i), s)), (*order(i), s))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (*order(i), s):
                gone[s:s + length] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest()) for r in df.collect()), key=str)


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    vocab = ["alpha", "bé", "gamma ray", "x", "日本語", "the", "of", "delta-wing", "q"]
    fresh = lambda k: " ".join(rng.choice(vocab, k).tolist() + [str(rng.integers(0, 99))])
    shared = [fresh(60) for _ in range(6)]
    docs = []
    for k in range(n):
        parts = [fresh(int(rng.integers(1, 40)))]
        for _ in range(int(rng.integers(0, 3))):
            own = shared[int(rng.integers(0, 6))]
            a = int(rng.integers(0, 60))
            parts += [own[a:a + int(rng.integers(20, 260))], fresh(int(rng.integers(0, 12)))]
        docs.append((k * 7 % n, "".join(parts)))
    return docs


@pytest.mark.parametrize("limits", [{}, {"crowd": 2, "run": 5}, {"max_bits": 10, "crowd": 3}, {"crowd": 1, "steps": (1,)}])
def test_equals_brute_force(spark, limits):
    docs = corpus(1)
    docs += [(100 + k, docs[3][1]) for k in range(20)] + [(200 + k, docs[5][1].replace("the", "a", 1)) for k in range(20)]  # copies, near copies
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute(docs, 100)
    assert sum(r[2] > 0 for r in want) > 30
    assert rows(S.remove_repeats(df, **limits)) == want


def test_short_lengths_and_periods(spark):
    docs = [(1, "ab" * 40), (2, "x" * 200), (3, "x" * 19), (4, "abcdefghijklmnopqrst" * 2), (5, "zabcdefghijklmnopqrst"), (6, "y" + "ab" * 12),
            (7, "12345678901234567890"), (8, "12345678901234567890"), (9, "0" * 5 + "12345678901234567890" + "9" * 5)]
    assert rows(S.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), length=20, gram=8)) == brute(docs, 20)


def test_nulls_repeats_ties_extra_columns(spark):
    p = "".join(chr(97 + k * k % 26) + str(k) for k in range(60))
    docs = [(None, p), (None, None), (1, p + "!"), (1, p + "!"), (1, "?" + p), (2, ""), (-5, p), (3, p[:99]), (4, p * 3), (5, "é" * 60)]
    df = spark.createDataFrame([(*r, 1, "t", 2) for r in docs], "doc_id long, text string, th int, spans string, h int")
    assert rows(S.remove_repeats(df)) == brute(docs, 100)


def test_long_text_over_blocks(spark):
    rng = np.random.default_rng(4)
    body = "".join(map(chr, rng.integers(97, 123, 30_000)))
    raw = np.frombuffer((body + body[500:9_000] + "-").encode(), np.uint8)
    whole = S.anchors(raw, np.array([0]), np.array([len(raw)]))
    parts = S.anchors(raw, np.array([0]), np.array([len(raw)]), chunk=1000)
    assert set(zip(*map(list, whole), strict=True)) == set(zip(*map(list, parts), strict=True))
    docs = [(1, body), (2, body[7_000:21_000] + "#" + body[:300]), (3, "#" + body[100:350])]
    assert rows(S.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs, 100)


def test_empty_table_and_no_repeat(spark):
    for docs in ([], [(1, "a"), (2, None)]):
        assert rows(S.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs, 100)


def test_maximal_repeats_with_all_places():
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab"), int(rng.integers(8, 60)))).encode() for _ in range(30)]
    texts += [t[3:25] for t in texts[:10]] + [b"\x00\x00" + texts[0], texts[1] + b"\x00"]
    group = np.arange(len(texts)) % 3
    got = {}
    for size, text, off in S.maximal_repeats(texts, group, 9):
        w = (int(group[text[0]]), texts[text[0]][off[0]:off[0] + size])
        assert len(w[1]) == size and w not in got
        got[w] = set(zip(text.tolist(), off.tolist(), strict=True))
    want = {}
    for g in range(3):
        held = {}
        for t, own in enumerate(texts):
            for size in range(9, len(own) + 1 if group[t] == g else 0):
                for a in range(len(own) - size + 1):
                    held.setdefault(own[a:a + size], []).append((t, a))
        for w, at in held.items():
            left = [texts[t][a - 1] if a else -t - 1 for t, a in at]
            right = [texts[t][a + len(w)] if a + len(w) < len(texts[t]) else -t - 1 for t, a in at]
            if len(at) > 1 and len(set(left)) > 1 and len(set(right)) > 1:
                want[g, w] = set(at)
    assert got == want


def test_wrong_parameters_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for limits in ({"gram": 24}, {"gram": 4}, {"length": 50}):
        with pytest.raises(ValueError):
            S.remove_repeats(df, **limits)


def test_strings_under_one_hash_stay_apart(monkeypatch):
    texts = [b"abcdefghijkl", b"xbcdefghijkl", b"abcdefghijzz", b"qqqqqqqqqqqq", b"ybcdefghijk!", b"abcdefghijkl?"]
    group = np.zeros(len(texts), np.int64)
    want = {(size, tuple(sorted(zip(t.tolist(), o.tolist(), strict=True)))) for size, t, o in S.maximal_repeats(texts, group, 9)}
    monkeypatch.setattr(S, "mix", lambda h: h * np.uint64(0))  # all hashes equal
    got = {(size, tuple(sorted(zip(t.tolist(), o.tolist(), strict=True)))) for size, t, o in S.maximal_repeats(texts, group, 9)}
    assert got == want and len(want) >= 3
