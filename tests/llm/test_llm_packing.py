import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from candlewick.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.vocabulary_path("word_bpe_49k.json"))


def test_word_ids_equal_whole_text_ids(tokenizer):
    rng = random.Random(1)
    chars = "aAbzZ09'sSßÄÖé ñÉÇ.,;:!?¿¡«»İıſΣς中²ªºé \x1c\t\x85\n "
    texts = ["".join(rng.choices(chars, k=60)) for _ in range(3000)] + ["a <|endoftext|>b<|startoftext|> c", "WE'LL don't 's"]
    encoder = P.WordEncoder(P.vocabulary_path("word_bpe_49k.json"))
    for text in texts:
        words = text.replace("\n", " ").split(" ")
        whole = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        ids, count = encoder.encode(pa.array(words))
        assert ids.tobytes() == whole and count.sum() == len(ids) and len(count) == len(words), text


def brute_fullest(counts, room):
    best = {0}
    for n, c in counts.items():
        best = {b + n * k for b in best for k in range(c + 1) if b + n * k <= room}
    return max(best)


def test_fullest_combination_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(0, 7))}
        room = rng.randint(0, 80)
        chosen = P.fullest(counts, room)
        assert sum(chosen) == brute_fullest(counts, room)
        assert all(chosen.count(n) <= counts[n] for n in set(chosen))


def test_plan_places_every_piece_once():
    rng = random.Random(4)
    histogram = {rng.randint(1, 64): rng.randint(1, 30) for _ in range(25)}
    rows, bins = P.plan(histogram, 64)
    held = {}
    for n, frm, to, copies, first, offset in rows:
        for r in range(frm, to):
            k = r - frm
            held.setdefault(first + k // copies, []).append((offset + k % copies * n, n))
    assert sum(len(v) for v in held.values()) == sum(histogram.values()) and len(held) == bins
    for own in held.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 64
    assert P.plan({}) == ([], 0)


def check(got, docs, tokenizer, size):
    for key, text in docs.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted((r for r in got if r["doc_id"] == key), key=lambda r: r["piece"])
        cuts = [ids[k:k + size] for k in range(0, len(ids), size)]
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own] == [
            (k, k * size, len(c), zlib.crc32(c.tobytes())) for k, c in enumerate(cuts)]
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= size
    return len(sequences)


def test_rows_nulls_long_texts_and_repeats(spark, tokenizer):
    docs = {1: None, 2: "", 3: "the cat " * 5000, 4: "the cat sat", 5: "on the mat . " * 30}
    rows = [(k, t, "x", 0) for k, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string, length int")
    got = P.pack(df, size=256).collect()
    total = sum(r["length"] for r in got)
    assert check(got, docs, tokenizer, 256) == -(-total // 256)
    twice = P.pack(df.unionByName(df).withColumn("doc_id", df["doc_id"])).collect()
    assert len(twice) == 2 * len(P.pack(df).collect())
    assert P.pack(df.limit(0)).count() == 0
    assert P.pack(spark.createDataFrame([(None, "the")], "doc_id long, text string")).first()["length"] == 2
