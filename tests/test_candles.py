from conftest import SF_SMALL, raw_rows, ts
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators.staging import stage_ticks
from candlewick.sources.fixtures import raw_ticks


def _staged(spark, rows):
    return stage_ticks(raw_rows(spark, rows))


def test_tie_on_timestamp_breaks_by_tick_id(spark):
    s = _staged(spark, [dict(tick_id="b", trade_price=1.0015), dict(tick_id="a", trade_price=1.0005)])
    c = C.ohlc_candles(s, "1min").first()
    assert float(c.open_price) == 1.0005 and float(c.close_price) == 1.0015


def test_single_tick_candle(spark):
    c = C.ohlc_candles(_staged(spark, [dict(tick_id="x")]), "5min").first()
    assert c.open_price == c.high_price == c.low_price == c.close_price
    assert float(c.price_change) == 0.0 and c.trade_count == 1


def test_tick_on_bucket_edge_belongs_to_bucket_starting_there(spark):
    s = _staged(spark, [dict(tick_id="e", transaction_timestamp=ts("2024-01-01 00:05:00")),
                        dict(tick_id="f", transaction_timestamp=ts("2024-01-01 00:04:59.999999"))])
    got = {r.candle_timestamp for r in C.ohlc_candles(s, "5min").collect()}
    assert got == {ts("2024-01-01 00:05:00"), ts("2024-01-01 00:00:00")}


def test_null_spread_ignored_by_spread_aggregates(spark):
    s = _staged(spark, [dict(tick_id="a", spread_bps=None), dict(tick_id="b", spread_bps=10.0)])
    c = C.ohlc_candles(s, "1h").first()
    assert float(c.avg_spread_bps) == 10.0 and float(c.min_spread_bps) == 10.0 and c.trade_count == 2


def test_spread_change_null_when_open_spread_zero(spark):
    s = _staged(spark, [dict(tick_id="a", bid_price=1.0, ask_price=1.0, mid_price=1.0, trade_price=1.0),
                        dict(tick_id="b", transaction_timestamp=ts("2024-01-01 05:00:00"))])
    c = C.ohlc_candles(s, "1d").first()
    assert c.spread_change_pct is None and c.num_trader_types == 1


def test_bad_interval_raises(spark):
    import pytest
    with pytest.raises(ValueError):
        C.ohlc_candles(_staged(spark, [dict()]), "7min")


def test_aggregate_form_equals_row_number_form(spark):
    s = stage_ticks(raw_ticks(spark, SF_SMALL))
    direct = C.ohlc_candles(s, "1min", metrics=False, calculated_at=False).select(
        "currency_pair", "candle_timestamp", "open_price", "close_price")
    b = C.bucket("transaction_timestamp", "1min")
    rn = C.add_row_numbers(s.withColumn("candle_timestamp", b), ["currency_pair", "candle_timestamp"],
                           ["transaction_timestamp", "tick_id"])
    ref = rn.groupBy("currency_pair", "candle_timestamp").agg(
        F.max(F.when(F.col("rn_first") == 1, F.col("trade_price"))).alias("open_price"),
        F.max(F.when(F.col("rn_last") == 1, F.col("trade_price"))).alias("close_price"))
    assert direct.exceptAll(ref).count() == 0 and ref.exceptAll(direct).count() == 0


def test_rollups_equal_direct_builds(spark):
    s = stage_ticks(raw_ticks(spark, SF_SMALL))
    for fine, coarse in (("1min", "5min"), ("5min", "1h"), ("1h", "1d")):
        state = C.candle_state(s, fine, C.CandleSpec(fine, trader_types=True, quotes=True))
        up = C.rollup_candles(state, coarse, calculated_at=False)
        direct = C.ohlc_candles(s, coarse, calculated_at=False)
        assert up.exceptAll(direct).count() == 0 and direct.exceptAll(up).count() == 0, (fine, coarse)


def test_candle_plan_has_one_shuffle_and_partial_aggregation(spark):
    s = stage_ticks(raw_ticks(spark, SF_SMALL))
    plan = C.ohlc_candles(s, "1h")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan and "Window" not in plan and "Sort " not in plan


def test_ratio_metrics_null_when_open_not_positive(spark):
    from decimal import Decimal
    c = spark.createDataFrame([(Decimal("0"), Decimal("1.5"), Decimal("2"), Decimal("0"))],
                              "open_price decimal(18,8), close_price decimal(18,8), high_price decimal(18,8), "
                              "low_price decimal(18,8)")
    r = C.with_price_metrics(c).first()
    assert r.price_change_pct is None and r.volatility_pct is None
    assert float(r.price_change) == 1.5 and float(r.price_range) == 2.0


def test_multi_grain_from_one_state_equals_direct(spark):
    s = stage_ticks(raw_ticks(spark, SF_SMALL))
    for reuse in ("checkpoint", "persist", None):
        grains = C.multi_grain_candles(s, calculated_at=False, reuse=reuse)
        for iv, got in grains.items():
            direct = C.ohlc_candles(s, iv, calculated_at=False)
            assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0, (reuse, iv)


def test_row_numbers_skew_safe_equal_window_form(spark):
    s = stage_ticks(raw_ticks(spark, SF_SMALL)).withColumn("b", C.bucket("transaction_timestamp", "1h"))
    a = C.add_row_numbers(s, ["currency_pair", "b"], ["transaction_timestamp", "tick_id"])
    w = C.add_row_numbers(s, ["currency_pair", "b"], ["transaction_timestamp", "tick_id"], skew_safe=False)
    cols = ["tick_id", "rn_first", "rn_last"]
    a2 = a.select(*[F.col(c).cast("long") for c in cols])
    w2 = w.select(*[F.col(c).cast("long") for c in cols])
    assert a2.exceptAll(w2).count() == 0 and w2.exceptAll(a2).count() == 0
