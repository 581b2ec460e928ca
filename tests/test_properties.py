"""Property tests: chunked sequences and roll-ups equal their plain forms on
random ticks with many timestamp ties and hot instants."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators import windows as WN

BASE = dt.datetime(2024, 1, 1, 10, 0, 0)
rows_strategy = st.lists(
    st.tuples(st.sampled_from(["ECR/MRT", "MRT/LCR"]),
              st.integers(min_value=0, max_value=7200).map(lambda s: s - s % 7),   # coarse -> ties
              st.integers(min_value=1, max_value=999)),
    min_size=1, max_size=60)


def _ticks(spark, rows):
    data = [(f"t{i:03d}", p, BASE + dt.timedelta(seconds=s), float(v)) for i, (p, s, v) in enumerate(rows)]
    return spark.createDataFrame(data, "tick_id string, currency_pair string, transaction_timestamp timestamp_ntz, "
                                       "mid_price double")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, n_chunks=st.integers(min_value=1, max_value=6))
def test_chunked_lag_and_seq_equal_plain_window(spark, rows, n_chunks):
    t = _ticks(spark, rows)
    w = Window.partitionBy("currency_pair").orderBy("transaction_timestamp", "tick_id")
    ref = t.select("tick_id", F.lag("mid_price").over(w).alias("p"), F.row_number().over(w).alias("seq"))
    for chunk in (WN.BALANCED, "1min"):
        got = WN.chunked_sequence(t, ["currency_pair"], ["transaction_timestamp", "tick_id"], ["mid_price"],
                                  chunk=chunk, n_chunks=n_chunks)
        got = got.select("tick_id", F.col("prev_mid_price").alias("p"), "seq")
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0, chunk


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_rollup_equals_direct_on_random_ticks(spark, rows):
    t = _ticks(spark, rows)
    from decimal import Decimal
    s = (t.withColumn("base_currency", F.split_part("currency_pair", F.lit("/"), F.lit(1)))
         .withColumn("quote_currency", F.split_part("currency_pair", F.lit("/"), F.lit(2)))
         .withColumn("trade_price", F.col("mid_price").cast("decimal(18,8)"))
         .withColumn("bid_price", F.col("mid_price").cast("decimal(18,8)"))
         .withColumn("ask_price", (F.col("mid_price") + 1).cast("decimal(18,8)"))
         .withColumn("volume", F.lit(Decimal("1.5")).cast("decimal(18,8)"))
         .withColumn("spread_bps", F.lit(Decimal("2.25")).cast("decimal(8,2)"))
         .withColumn("exchange_location", F.lit("Earth_FX_Hub"))
         .withColumn("trader_type", F.when(F.col("mid_price") > 500, "retail").otherwise("government")))
    state = C.candle_state(s, "1min", C.CandleSpec("1min", trader_types=True, quotes=True))
    for coarse in ("5min", "1h"):
        up = C.rollup_candles(state, coarse, calculated_at=False)
        direct = C.ohlc_candles(s, coarse, calculated_at=False)
        assert up.exceptAll(direct).count() == 0 and direct.exceptAll(up).count() == 0, coarse
