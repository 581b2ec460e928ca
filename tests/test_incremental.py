import datetime as dt

from conftest import SF_SMALL, raw_rows, ts
from pyspark.sql import functions as F

from candlewick.operators.candles import ohlc_candles
from candlewick.operators.staging import stage_ticks
from candlewick.functions.columns import ntz_lit
from candlewick.plans import incremental as INC
from candlewick.session import scratch_path
from candlewick.sources.fixtures import raw_ticks


def test_empty_target_means_full_build(spark):
    s = stage_ticks(raw_rows(spark, [dict(tick_id="a")]))
    empty = ohlc_candles(s, "1min").limit(0)
    assert INC.incremental_slice(s, empty, "1min").count() == 1


def test_cutoff_floored_to_grid_for_misaligned_lookback():
    # 5min grain, lookback 7: 10:20 - 7 = 10:13 -> floored to 10:10 (no partial candle)
    assert INC.incremental_cutoff(ts("2024-01-01 10:20:00"), "5min", 7) == ts("2024-01-01 10:10:00")
    assert INC.incremental_cutoff(None, "5min", 7) is None


def test_misaligned_lookback_never_overwrites_with_partial_candle(spark, tmp_path):
    rows = [dict(tick_id=f"t{i}", transaction_timestamp=ts("2024-01-01 10:10:00") + dt.timedelta(minutes=i),
                 trade_price=1.001 + i * 1e-5) for i in range(11)]
    s = stage_ticks(raw_rows(spark, rows))
    path = str(tmp_path / "c5")
    INC.build_candles(spark, s, path, "5min", full_refresh=True)
    INC.build_candles(spark, s, path, "5min", lookback_minutes=7)
    got = INC.read_partitioned(spark, path).drop("partition", "calculated_at")
    full = ohlc_candles(s, "5min", calculated_at=False)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_late_tick_inside_lookback_updates_outside_is_reported(spark, tmp_path):
    base = [dict(tick_id="a", transaction_timestamp=ts("2024-01-01 10:00:00")),
            dict(tick_id="b", transaction_timestamp=ts("2024-01-01 10:30:00"))]
    path = str(tmp_path / "c1")
    s0 = stage_ticks(raw_rows(spark, base))
    INC.build_candles(spark, s0, path, "1min", full_refresh=True)
    late_in = dict(tick_id="c", transaction_timestamp=ts("2024-01-01 10:27:30"), trade_price=1.0019,
                   event_time=ts("2024-01-01 10:31:00"))
    late_out = dict(tick_id="d", transaction_timestamp=ts("2024-01-01 10:00:10"), trade_price=1.0001,
                    event_time=ts("2024-01-01 10:31:00"))
    s1 = stage_ticks(raw_rows(spark, base + [late_in, late_out]))
    INC.build_candles(spark, s1, path, "1min")
    got = {r.candle_timestamp: r for r in INC.read_partitioned(spark, path).collect()}
    assert ts("2024-01-01 10:27:00") in got                       # inside lookback: added
    assert got[ts("2024-01-01 10:00:00")].trade_count == 1          # outside: unchanged
    cutoff = INC.incremental_cutoff(ts("2024-01-01 10:30:00"), "1min")
    late = INC.late_ticks(s1, cutoff, ts("2024-01-01 10:30:30")).collect()
    assert [(r.candle_timestamp, r.late_ticks) for r in late] == [(ts("2024-01-01 10:00:00"), 1)]


def test_incremental_equals_full_on_fixture(spark):
    s = stage_ticks(raw_ticks(spark, SF_SMALL))
    mid = s.agg(F.percentile_approx(F.unix_micros(F.col("transaction_timestamp").cast("timestamp")), 0.5)).first()[0]
    t0 = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=mid)
    for iv in ("1min", "1h", "1d"):
        path = scratch_path(spark, f"inc_{iv}")
        INC.build_candles(spark, s.where(F.col("transaction_timestamp") < ntz_lit(t0)), path, iv, full_refresh=True)
        INC.build_candles(spark, s, path, iv)
        got = INC.read_partitioned(spark, path).drop("partition", "calculated_at")
        full = ohlc_candles(s, iv, calculated_at=False)
        assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0, iv


def test_upsert_dataframe_form(spark):
    t = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0)], "currency_pair string, candle_timestamp int, v double")
    u = spark.createDataFrame([("A", 2, 5.0), ("A", 3, 3.0)], "currency_pair string, candle_timestamp int, v double")
    got = sorted(tuple(r) for r in INC.upsert(t, u).collect())
    assert got == [("A", 1, 1.0), ("A", 2, 5.0), ("A", 3, 3.0)]


def test_as_of_and_scd2(spark):
    h = spark.createDataFrame([("A", 1, 1.0, ts("2024-01-01 00:00:00")), ("A", 1, 2.0, ts("2024-01-02 00:00:00")),
                               ("B", 1, 7.0, ts("2024-01-01 00:00:00"))],
                              "currency_pair string, candle_timestamp int, v double, calculated_at timestamp_ntz")
    a = {(r.currency_pair, r.v) for r in INC.candles_as_of(h, ts("2024-01-01 12:00:00")).collect()}
    assert a == {("A", 1.0), ("B", 7.0)}
    s = INC.scd2(h, ["currency_pair", "candle_timestamp"], "calculated_at")
    cur = {(r.currency_pair, r.v) for r in s.where("is_current").collect()}
    assert cur == {("A", 2.0), ("B", 7.0)}


def test_merge_into_needs_a_merge_capable_table(spark):
    import pytest
    name = "cw_plain_parquet_candles"
    t = spark.createDataFrame([("A", 1, 1.0)], "currency_pair string, candle_timestamp int, v double")
    t.write.mode("overwrite").format("parquet").saveAsTable(name)
    try:
        with pytest.raises(Exception):
            INC.merge_into(t, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
