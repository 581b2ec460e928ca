import random

from candlewick.llm import token_counts as T


def brute(word, scores, unknown):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        reached = [(best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in scores]
        if word[end - 1] not in scores:
            n = len(word[end - 1].encode())
            reached.append((best[end - 1][0] + n * unknown, best[end - 1][1] - n))
        best.append(max(reached))
    return -best[-1][1]


def test_shared_prefixes_against_word_by_word():
    rng = random.Random(5)
    scores = {c: -rng.uniform(8, 12) for c in "▁abcd"}
    scores |= {"".join(rng.choices("▁abcd", k=rng.randint(2, 6))): -rng.uniform(2, 12) for _ in range(120)}
    words = {"▁" + "".join(rng.choices("abcdéz", k=rng.randint(0, 14))) for _ in range(1500)} | {"▁" + "ab" * 3000}
    got = T.trie_counts(words, scores)
    assert got == {w: brute(w, scores, min(scores.values()) - 10) for w in words}
    assert T.trie_counts([], scores) == {}


def test_against_a_public_unigram_model():
    from tokenizers.models import Unigram
    scores = T.load_scores(T.vocabulary_path("piece_bpe_32k.model"))
    model = Unigram([("<unk>", 0.0), *scores.items()], 0, False)
    words = ["▁the", "▁retitioning", "▁whsted,", "▁ouxauxanoi", "▁Ciónboga", "▁lichkeit", "▁unbelievably", "▁token="]
    assert T.trie_counts(words, scores) == {w: len(model.tokenize(w)) for w in words}


def test_rows_nulls_and_empty_table(spark):
    long = "word " * 40_000
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "the cat"), (4, "the cat"), (None, "the"), (5, long)], "doc_id long, text string")
    out = [(r["doc_id"], r["n_pretokens"], r["n_tokens"]) for r in T.count_tokens(docs).collect()]
    scores = T.load_scores(T.vocabulary_path("piece_bpe_32k.model"))
    the, cat, word = T.trie_counts(["▁the", "▁cat", "▁word"], scores).values()  # in sorted order: cat, the, word
    two = (4, 2, the + cat)
    one = T.trie_counts(["▁the"], scores)["▁the"]
    assert sorted(out, key=str) == sorted([(1, 0, 0), (2, 0, 0), (3, 0, 0), two, two, (None, 1, one), (5, 40_000, 40_000 * word)], key=str)
    assert T.count_tokens(docs.limit(0)).count() == 0
    assert T.count_tokens(docs.withColumnRenamed("text", "n_tokens"), text_col="n_tokens").count() == 7
