from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators import stats as SS
from candlewick.operators import windows as WN
from candlewick.operators.staging import stage_ticks
from candlewick.sources.fixtures import raw_ticks


def _ticks(spark):
    return stage_ticks(raw_ticks(spark, SF_SMALL))


def test_lag_across_chunks_equals_plain_lag(spark):
    t = _ticks(spark)
    w = Window.partitionBy("currency_pair").orderBy("transaction_timestamp", "tick_id")
    ref = t.select("tick_id", F.lag("mid_price").over(w).alias("p"))
    for chunk in ("1min", "1h", "1d"):
        got = WN.lag_across_chunks(t, ["currency_pair"], ["transaction_timestamp", "tick_id"], ["mid_price"], chunk)
        got = got.select("tick_id", F.col("prev_mid_price").alias("p"))
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0, chunk


def test_max_gap_equals_brute_force(spark):
    t = _ticks(spark)
    w = Window.partitionBy("currency_pair").orderBy("transaction_timestamp")
    ref = (t.withColumn("g", F.timestamp_diff("MICROSECOND", F.lag("transaction_timestamp").over(w),
                                              F.col("transaction_timestamp")))
           .groupBy("currency_pair").agg(F.count(F.lit(1)).alias("tick_count"), F.max("g").alias("max_gap_us")))
    for chunk in ("1min", "1h"):
        got = WN.max_gap(t, ["currency_pair"], chunk=chunk)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_sequenced_and_small_blocks_match_plain_window(spark):
    t = _ticks(spark)
    w = Window.partitionBy("currency_pair").orderBy("transaction_timestamp", "tick_id")
    seq = WN.sequenced(t, ["currency_pair"], ["transaction_timestamp", "tick_id"], "1h")
    ref_seq = t.select("tick_id", F.row_number().over(w).alias("seq"))
    assert seq.select("tick_id", "seq").exceptAll(ref_seq).count() == 0
    x = seq.withColumn("x", F.col("mid_price").cast("double"))
    got = WN.rolling_rows(x, ["currency_pair"], "seq", 5, {"s": F.sum("x")}, block_rows=7)
    ref = x.withColumn("s", F.sum("x").over(w.rowsBetween(-4, 0)))
    cmp = got.select("tick_id", F.round("s", 9).alias("s"))
    cref = ref.select("tick_id", F.round("s", 9).alias("s"))
    assert cmp.count() == t.count() and cmp.exceptAll(cref).count() == 0


def test_realized_vol_block_size_independent(spark):
    t = _ticks(spark)
    a = SS.realized_vol(t, block_rows=100_000).select("tick_id", F.round("realized_volatility", 9).alias("v"))
    b = SS.realized_vol(t, block_rows=150).select("tick_id", F.round("realized_volatility", 9).alias("v"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_balanced_chunks_equal_plain_windows(spark):
    t = _ticks(spark)
    w = Window.partitionBy("currency_pair").orderBy("transaction_timestamp", "tick_id")
    ref = t.select("tick_id", F.lag("mid_price").over(w).alias("p"), F.row_number().over(w).alias("seq"))
    got = WN.chunked_sequence(t, ["currency_pair"], ["transaction_timestamp", "tick_id"], ["mid_price"],
                              chunk=WN.BALANCED, n_chunks=7)
    got = got.select("tick_id", F.col("prev_mid_price").alias("p"), "seq")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    g1 = WN.max_gap(t, ["currency_pair"], chunk=WN.BALANCED, n_chunks=5)
    g2 = WN.max_gap(t, ["currency_pair"], chunk="1d")
    assert g1.exceptAll(g2).count() == 0 and g2.exceptAll(g1).count() == 0
    a = SS.realized_vol(t, chunk=WN.BALANCED, n_chunks=9, block_rows=200).select("tick_id", F.round("realized_volatility", 9))
    b = SS.realized_vol(t).select("tick_id", F.round("realized_volatility", 9))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_balanced_chunks_split_a_single_hot_instant(spark):
    # every row at the same instant: time chunks would give one task, ranks split it
    rows = [(f"t{i:04d}", "ECR/MRT", float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "tick_id string, currency_pair string, v double") \
        .withColumn("transaction_timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    got = WN.chunked_sequence(df, ["currency_pair"], ["transaction_timestamp", "tick_id"], ["v"],
                              chunk=WN.BALANCED, n_chunks=8)
    assert got.where(F.col("prev_v") != F.col("v") - 1).count() == 0 and got.agg(F.max("seq")).first()[0] == 400
    chunks = WN._with_chunk(df, ["currency_pair"], ["transaction_timestamp", "tick_id"], WN.BALANCED, 8)
    sizes = [r[1] for r in chunks.groupBy("_chunk").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 400


def test_null_keys_grouped_like_a_plain_window(spark):
    t = _ticks(spark).withColumn("currency_pair", F.when(F.col("tick_id").cast("long") % 5 == 0, F.lit(None))
                                 .otherwise(F.col("currency_pair")))
    w = Window.partitionBy("currency_pair").orderBy("transaction_timestamp", "tick_id")
    ref = t.select("tick_id", F.lag("mid_price").over(w).alias("p"), F.row_number().over(w).alias("seq"))
    for chunk in (WN.BALANCED, "1h"):
        got = WN.chunked_sequence(t, ["currency_pair"], ["transaction_timestamp", "tick_id"], ["mid_price"],
                                  chunk=chunk, n_chunks=5)
        got = got.select("tick_id", F.col("prev_mid_price").alias("p"), "seq")
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0, chunk
