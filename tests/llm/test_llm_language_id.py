import zlib

import numpy as np

from candlewick.llm import language_id as L


def test_marginals_against_word_by_word():
    rng = np.random.default_rng(1)
    trans, lengths = rng.random((4, 4)) + 3 * np.eye(4), [1, 5, 31, 32, 33, 200, 64]
    pot = rng.random((sum(lengths), 4))
    got, at = L.chain_marginals(pot, np.array(lengths), trans), 0
    for n in lengths:
        own, now, ahead = pot[at:at + n], np.full(4, 0.25), []
        for row in own:
            now = (now @ trans) * row
            now = now / now.sum()
            ahead.append(now)
        back, want = np.ones(4), []
        for t in range(n - 1, -1, -1):
            g = ahead[t] * back
            want.append(g / g.sum())
            back = trans @ (own[t] * back)
            back = back / back.sum()
        assert np.allclose(got[at:at + n], want[::-1])
        at += n


def test_features_and_core():
    assert [L.core(w) for w in ("word", "(word),", "«été»", "42", "", "a-b", "x1")] == ["word", "word", "été", "", "", "a-b", "x"]
    number, bucket = L.features(["", "ab", "ab", "zz"], {"ab": (0, 2)})
    assert not (number == 0).any() and (bucket[number == 1] == bucket[number == 2]).all()
    assert set(bucket[number == 1]) >= {L.BUCKETS, L.BUCKETS + 2} and max(bucket[number == 3]) < L.BUCKETS


def test_gradient_of_training_raises_the_likelihood_and_transitions_stay():
    rows = [("aa", "lorem ipsum dolor " * 40), ("bb", "huius kwart zeppo " * 40)]
    model = L.train(rows, length=8, rounds=30)
    assert model["langs"] == ["aa", "bb"] and np.diag(model["trans"]).min() > model["trans"][0, 1]


def test_held_out_accuracy_code_switching_and_edge_cases(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = L.op5_language_id(spark, sf).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in zip(out.doc_id, out.held_out))
    assert (out[out.held_out].lang == out[out.held_out].lang_pred).mean() >= 0.97
    model = L.train(L.sample(docs, per_lang=60))
    texts = {r["lang"]: r["text"][:300] for r in docs.where("n_chars > 400").collect()}
    rows = [(1, None), (2, ""), (3, "42 :: 17"), (4, texts["de"] + " " + texts["fr"] * 3), (5, texts["es"] * 700), (6, "word"), (6, "word")]
    got = sorted((r["doc_id"], r["p"]["lang_pred"], r["p"]["score"]) for r in
                 spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", L.predict_udf(spark, model)("text").alias("p")).collect())
    assert [g[1] for g in got[:5]] == ["und", "und", "und", "fr", "es"] and [g[2] for g in got[:3]] == [0, 0, 0]
    assert 0.5 < got[3][2] < 0.9 and got[5] == got[6] and all(0 <= g[2] <= 1 for g in got)


def test_without_labels_or_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.sample(empty) == [] and L.train([]) is None
    one = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert L.sample(one) == []
    assert one.select(L.predict_udf(spark, None)("text").alias("p")).first()["p"]["lang_pred"] == "und"


def test_few_words_and_many_languages(spark):
    few = L.train([("en", "the cat sat on the mat and the dog ran"), ("de", "der hund und die katze sind im haus")])
    assert sorted(few["langs"]) == ["de", "en"]
    docs = spark.createDataFrame([(1, "the cat"), (2, "die katze"), (3, "7")], "doc_id long, text string")
    got = {r["doc_id"]: r["p"]["lang_pred"] for r in docs.select("doc_id", L.predict_udf(spark, few)("text").alias("p")).collect()}
    assert got == {1: "en", 2: "de", 3: "und"}
    assert L.train([("en", "one")])["langs"] == ["en"] and L.train([("en", "42 !"), ("de", "")]) is None
    many = [(f"l{k:02d}", f"word{chr(97 + k // 9)}{chr(97 + k % 9)} " * 30) for k in range(70)]
    lexicon = L.train(many, rounds=1)["lexicons"]
    assert lexicon["wordhg"] == (69,) and len(lexicon) == 70


def test_whole_rows_of_a_bounded_sample(spark):
    long = "lang zwei " * 5000
    rows = [(k, f"row {k} " * 50, "aa") for k in range(400)] + [(900, long, "bb"), (901, long * 2, "bb"), (902, None, "cc"), (903, "x", None)]
    got = L.sample(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, draw int"), per_lang=40)
    texts = {r[1] for r in rows}
    assert {t for _, t in got} <= texts and 15 < sum(lang == "aa" for lang, _ in got) < 80 and [t for lang, t in got if lang == "bb"] == [long]


def test_predictions_against_a_plain_chain(spark):
    model = L.train([("en", "the cat sat on the mat and the dog ran " * 9), ("de", "der hund und die katze sind im haus " * 9), ("fr", "le chat est dans la maison " * 9)], rounds=20)
    texts = ["the katze and 42 le chat est", "der der the", "mat", "le " * 100 + "the " * 90, "... haus!"]
    docs = spark.createDataFrame([(i, t, "zz", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, score double")
    got = {r["doc_id"]: (r["p"]["lang_pred"], r["p"]["score"]) for r in docs.select("doc_id", L.predict_udf(spark, model)("text").alias("p")).collect()}
    k = len(model["langs"])
    for i, text in enumerate(texts):
        cores = [L.core(w) for w in text.lower().split()]
        pots = []
        for c in cores:
            number, bucket = L.features([c], model["lexicons"])
            score = model["weights"][bucket].sum(0) / np.sqrt(max(1, len(number)))
            pots.append(np.exp(score - score.max()))
        now, ahead = np.full(k, 1 / k), []
        for p in pots:
            now = (now @ model["trans"]) * p
            now = now / now.sum()
            ahead.append(now)
        back, mean, n = np.ones(k), np.zeros(k), 0
        for a, p, c in list(zip(ahead, pots, cores, strict=True))[::-1]:
            if c:
                mean, n = mean + a * back / (a @ back), n + 1
            back = model["trans"] @ (p * back)
            back = back / back.sum()
        assert got[i][0] == model["langs"][int(mean.argmax())] and abs(got[i][1] - mean.max() / n) < 1e-4
