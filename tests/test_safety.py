"""Nothing may lose data, and every registered scenario must be able to fail."""
import datetime as dt

import pytest
from conftest import SF_SMALL, raw_rows, ts
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from candlewick.functions.columns import ntz_lit
from candlewick.operators import events as EV
from candlewick.operators.candles import ohlc_candles
from candlewick.operators.staging import stage_ticks
from candlewick.plans import incremental as INC
from candlewick.plans import registry as R
from candlewick.sources import wire as W
from candlewick.sources.fixtures import economic_events, raw_ticks
from candlewick.streaming.candles import default_delay, stream_candles
from candlewick.streaming.ingest import read_tick_stream


def _table(spark, tmp_path):
    rows = [dict(tick_id=f"t{i}", transaction_timestamp=ts("2024-01-01 10:00:00") + dt.timedelta(minutes=i)) for i in range(90)]
    path = str(tmp_path / "c")
    ticks = stage_ticks(raw_rows(spark, rows))
    INC.build_candles(spark, ticks, path, "1h", full_refresh=True)
    return path, ticks, sorted(map(str, INC.read_partitioned(spark, path).collect()))


def test_a_read_error_never_replaces_the_table(spark, tmp_path, monkeypatch):
    path, ticks, before = _table(spark, tmp_path)
    real = DataFrameReader.load

    def broken(self, *a, **k):
        raise OSError("storage does not answer")
    monkeypatch.setattr(DataFrameReader, "load", broken)
    with pytest.raises(OSError):
        INC.build_candles(spark, ticks, path, "1h")
    with pytest.raises(OSError):
        INC.build_all_candles(spark, ticks, str(tmp_path / "all"))
    monkeypatch.setattr(DataFrameReader, "load", real)
    assert sorted(map(str, INC.read_partitioned(spark, path).collect())) == before


def test_an_unreadable_folder_is_not_a_missing_table(spark, tmp_path):
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader says
        INC.read_or_none(spark, str(tmp_path / "odd"), "parquet")
    assert INC.read_or_none(spark, str(tmp_path / "none"), "parquet") is None


@pytest.mark.parametrize("change", [lambda c: c.drop("trade_count"), lambda c: c.withColumn("new", F.lit(1)),
                                    lambda c: c.withColumn("trade_count", F.col("trade_count").cast("string"))])
def test_schema_drift_fails_and_leaves_the_table(spark, tmp_path, change):
    path, _, before = _table(spark, tmp_path)
    updates = change(INC.read_partitioned(spark, path))
    with pytest.raises(AssertionError, match="schema change"):
        INC.upsert_path(spark, path, updates)
    assert sorted(map(str, INC.read_partitioned(spark, path).collect())) == before


def test_revised_candles_need_the_update_to_win(spark, monkeypatch):
    assert R.q_revised_candles(spark, SF_SMALL.replace("0.001", "0.01")).count() > 0
    target = spark.createDataFrame([(1, "old"), (2, "kept")], "k int, v string")
    updates = spark.createDataFrame([(1, "new"), (3, "added")], "k int, v string")
    assert sorted(map(tuple, INC.upsert(target, updates, ["k"]).collect())) == [(1, "new"), (2, "kept"), (3, "added")]
    with pytest.raises(AnalysisException):
        INC.upsert(target, updates.withColumn("x", F.lit(1)), ["k"])


def test_impact_is_the_same_on_both_paths_for_repeated_ticks_and_null_multipliers(spark):
    ticks = stage_ticks(raw_ticks(spark, SF_SMALL))
    ticks = ticks.unionByName(ticks).unionByName(ticks.withColumn("tick_id", F.lit("same")))
    events = economic_events(spark, SF_SMALL).withColumn("spread_multiplier", F.when(F.col("severity") != 3, F.col("spread_multiplier")))
    events = events.unionByName(events.withColumn("volume_multiplier", F.lit(None).cast("double")))
    a, b = (EV.event_impact(ticks, events, max_broadcast_rows=n).select(R._IMPACT_COLS) for n in (10**6, 0))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


@pytest.mark.parametrize("files", [1, 8])
def test_streaming_candles_do_not_depend_on_files(spark, tmp_path, files):
    raw = raw_ticks(spark, SF_SMALL)
    src, table, ck = (str(tmp_path / n) for n in ("src", "table", "ck"))
    middle = raw.select(F.percentile_approx("transaction_timestamp", 0.5)).first()[0]
    dropped = 0
    for part in (raw.where(F.col("transaction_timestamp") <= ntz_lit(middle)), raw.where(F.col("transaction_timestamp") > ntz_lit(middle))):
        W.to_wire(part).repartition(files).write.mode("append").json(src)
        q = stream_candles(stage_ticks(W.parse_raw_ticks(read_tick_stream(spark, path=src))), "1h", table, ck, available_now=True)
        q.awaitTermination()
        dropped += sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators)
    batch = ohlc_candles(stage_ticks(raw), "1h", calculated_at=False)
    got = INC.read_partitioned(spark, table).select(batch.columns)
    assert dropped == 0 and got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert default_delay("1h") == "180 minutes" and default_delay("1min") == "6 minutes"


def test_scenarios_return_rows(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    assert R.q_orphan_exchanges(spark, sf).count() > 0
    assert R.q_late_ticks(spark, sf).count() > 0
    assert R.q_ohlc_violations_broken(spark, sf).count() > 0
    first, last = R.q_candles_as_of_first(spark, sf), R.q_candles_as_of(spark, sf)
    assert first.count() < last.count()
