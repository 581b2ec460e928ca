"""Quality classifier: regularised quadratic discriminant over document statistics.

A text's statistics (lengths, shares of character and word kinds, repetition,
compressibility) are transformed towards normality.  Class means and covariances
come from sums over every labelled training row, added up in Spark; a covariance
is shrunk towards the pooled one and then towards its diagonal, with a floor from
the pooled variances (so that a short or unusual clean text is not ruled out by one
nearly constant statistic), and its Cholesky factor is inverted once.  The score is the logistic of the difference of the two
Mahalanobis log-densities plus the log prior.

Defined results: a null text is an empty text, and an empty text has a score;
labels that are null or neither 0 nor 1 are ignored, repeated ones count each; if a
class has no training row the score is 0.5 for every text; whole texts of any length and in any
script are measured; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import cut, give_back_memory, held_out, map_codes, table

THRESHOLD, POOLED, RIDGE, FLOOR = 0.7, 0.5, 0.02, 0.1
LOWER, UPPER, DIGIT, BLANK, MARK, SYMBOL = range(6)


def _kind(code: int) -> int:
    c = chr(code)
    if c.isalpha():
        return UPPER if c.isupper() else LOWER
    if c.isdigit():
        return DIGIT
    if c.isspace():
        return BLANK
    return MARK if c in ".,;:?'\"-()¿¡«»…–—。、「」『』・！？，．：；" else SYMBOL


def _char_kinds() -> np.ndarray:
    """Kinds of the first code points; ``map_codes`` asks for those beyond."""
    return np.array([_kind(code) for code in range(0x3000)], np.uint8)


def statistics(text: str, kinds: np.ndarray, compress) -> list[float]:
    """The transformed statistics of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = np.bincount(map_codes(codes, kinds, _kind), minlength=6)
    words, lines = text.split(), text.split("\n")
    count, distinct = len(words), len(set(words))
    letters = max(1, n[LOWER] + n[UPPER])
    joined = sum(map(str.__eq__, words, words[1:]))
    bare = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:?'\")»")
    def share(part: float, whole: float) -> float:
        return float(np.arcsin(np.sqrt(min(1.0, part / max(1, whole)))))
    return [
        np.log1p(len(text)), np.log1p(count), np.log1p((len(text) - n[BLANK]) / max(1, count)),
        share(n[UPPER], letters), share(n[DIGIT], len(text)), share(n[MARK], len(text)), share(n[SYMBOL], len(text)),
        share(n[LOWER], len(text)), share(bare, count), np.log1p(distinct) / max(1.0, np.log1p(count)),
        share(joined, count), share(len(lines) - len(set(lines)), len(lines)), np.log1p(len(text) / len(lines)),
        min(2.0, len(compress(raw)) / max(1, len(raw))),
    ]


def statistics_udf():
    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zstandard
        kinds, compress = _char_kinds(), zstandard.ZstdCompressor(level=1).compress
        for texts in batches:
            yield pd.Series([statistics(text or "", kinds, compress) for text in texts])
            give_back_memory()

    return measure


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each class and batch: rows, sums and sums of products."""
    for b in batches:
        for label, own in b.groupby("label"):
            x = np.stack(own["x"].to_numpy())
            yield pd.DataFrame({"label": [label], "v": [[float(len(x)), *x.sum(0), *(x.T @ x).ravel()]]})


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> dict | None:
    """The discriminant from (id, x) rows joined with every label of theirs; None if a class has no row."""
    told = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    rows = stats.select(F.col(id_col).alias("_id"), "x").join(told, "_id").select("label", "x")
    parts = rows.mapInPandas(_sums, "label int, v array<double>")
    sums = parts.select("label", F.posexplode("v").alias("k", "v")).groupBy("label", "k").agg(F.sum("v").alias("v")).collect()
    of = {c: np.array([r["v"] for r in sorted((r for r in sums if r["label"] == c), key=lambda r: r["k"])]) for c in (0, 1)}
    if not all(len(v) for v in of.values()):
        return None
    d = round((np.sqrt(4 * len(of[0]) - 3) - 1) / 2)
    n, mean, cov = {}, {}, {}
    for c, v in of.items():
        n[c], mean[c] = v[0], v[1:d + 1] / v[0]
        cov[c] = v[d + 1:].reshape(d, d) / v[0] - np.outer(mean[c], mean[c])
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    scale = np.diag(pooled) + 1e-6
    model = {"prior": float(np.log(n[1] / n[0]))}
    for c in (0, 1):
        own = (1 - POOLED) * cov[c] + POOLED * pooled
        own = (1 - RIDGE) * own + np.diag(RIDGE * np.maximum(np.diag(own), 0) + FLOOR * scale)
        factor = np.linalg.cholesky((own + own.T) / 2)
        model[c] = (mean[c], np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()))
    return model


def log_odds(x: np.ndarray, model: dict) -> np.ndarray:
    density = {}
    for c in (0, 1):
        mean, inverse, log_det = model[c]
        density[c] = -0.5 * (np.square((x - mean) @ inverse.T).sum(1) + log_det)
    return density[1] - density[0] + model["prior"]


def score_udf(model: dict | None):
    """Statistics to score."""
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if model is None or x.empty:
            return pd.Series(np.full(len(x), 0.5))
        return pd.Series(1 / (1 + np.exp(-np.clip(log_odds(np.stack(x.to_numpy()), model), -500, 500))))

    return score


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = cut(docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"),
                            statistics_udf()(F.col("text")).alias("x")))
    model = fit(stats.where("not held_out"), table(spark, sf_dir, "labels"))
    scored = stats.select("doc_id", "held_out", score_udf(model)(F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose text is not rejected; without a model all rows stay."""
    trained = docs.where(~held_out(F.col(id_col), 4, 2)).select(id_col, statistics_udf()(F.col(text_col)).alias("x"))
    model = fit(trained, labels, id_col)
    if model is None:
        return docs
    return docs.where(score_udf(model)(statistics_udf()(F.col(text_col))) >= THRESHOLD)
