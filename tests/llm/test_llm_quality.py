import zlib

import numpy as np

from candlewick.llm import quality as Q


def test_scores_equal_the_textbook_densities(spark):
    rng = np.random.default_rng(0)
    x = {0: rng.normal(0, 1, (80, 4)) @ rng.normal(0, 1, (4, 4)), 1: rng.normal(1, 2, (120, 4))}
    stats = [(i, list(map(float, v)), c) for c in x for i, v in enumerate(x[c], 1000 * c)]
    df = spark.createDataFrame([(i, v) for i, v, _ in stats], "doc_id long, x array<double>")
    told = [(i, c) for i, _, c in stats] + [(1, None), (2, 7), (99999, 1), (None, 1)]
    model = Q.fit(df, spark.createDataFrame(told, "doc_id long, quality int"))
    pooled = sum(len(x[c]) * np.cov(x[c].T, bias=True) for c in x) / 200
    logs = {}
    every = np.concatenate([x[0], x[1]])
    for c in x:
        own = (1 - Q.POOLED) * np.cov(x[c].T, bias=True) + Q.POOLED * pooled
        own = (1 - Q.RIDGE) * own + np.diag(Q.RIDGE * np.diag(own) + Q.FLOOR * (np.diag(pooled) + 1e-6))
        off = every - x[c].mean(0)
        logs[c] = -0.5 * (np.einsum("ij,jk,ik->i", off, np.linalg.inv(own), off) + np.linalg.slogdet(own)[1])
    assert np.allclose(Q.log_odds(every, model), logs[1] - logs[0] + np.log(120 / 80))


def test_held_out_accuracy_and_no_leak(spark):
    sf = "/root/testdata/sf0.01"
    out = Q.op1_quality_classifier(spark, sf).toPandas()
    told = spark.read.parquet(f"{sf}/labels.parquet").toPandas().merge(out, on="doc_id")
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(out.doc_id, out.held_out))
    held = told[told.held_out]
    assert len(held) > 50 and (held.quality == held.predicted).mean() >= 0.97
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.7)).all()


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (4, "é" * 300_000, "d"), (4, "One. Two, three", "e"), (None, "x y", "f")],
                                 "doc_id long, text string, x string")
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    assert Q.accepted(docs, labels).count() == 6  # one class only: nothing is rejected
    stats = docs.select("doc_id", Q.statistics_udf()("text").alias("x"))
    assert [len(r["x"]) for r in stats.collect()] == [14] * 6 and all(np.isfinite(r["x"]).all() for r in stats.collect())
    assert [r["s"] for r in stats.select(Q.score_udf(None)("x").alias("s")).collect()] == [0.5] * 6
    both = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (4, 0)], "doc_id long, quality int")
    assert Q.accepted(docs, both).columns == docs.columns
    assert Q.accepted(docs.limit(0), both).count() == 0


def test_letters_of_all_scripts_are_letters(spark):
    kinds = Q._char_kinds()
    for text in ("日本語の文章です", "한국어 문장입니다", "𐐀𐐁 𝕬𝖇", "Ελληνικά ქართული"):
        x = Q.statistics(text, kinds, lambda raw: raw)
        assert x[6] == 0, text  # no symbols
    assert Q.statistics("☃☃☃𝌆", kinds, lambda raw: raw)[6] > 1
    long = Q.statistics("ab cd. " * 200_000, kinds, lambda raw: raw)
    assert np.isfinite(long).all()
    docs = spark.createDataFrame([(1, "a b", 0, 1.0)], "doc_id long, text string, label int, x double")
    both = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, quality int")
    assert Q.accepted(docs, both).columns == docs.columns
