"""Plan-level checks: filters reach the Parquet scan, columns are pruned, no
Python evaluation or nested-loop joins anywhere in the registered queries."""

import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from candlewick.operators.candles import ohlc_candles
from candlewick.operators.staging import stage_ticks
from candlewick.plans import incremental as INC
from candlewick.plans import registry
from candlewick.sources.fixtures import economic_events, raw_ticks
from candlewick.operators.events import scaled_effects


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_cutoff_is_pushed_to_the_scan(spark):
    s = stage_ticks(raw_ticks(spark, SF_SMALL))
    target = ohlc_candles(s.where(F.col("transaction_timestamp") < F.lit("2024-01-15").cast("timestamp_ntz")), "1h")
    plan = _plan(INC.incremental_slice(s, target, "1h"))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThanOrEqual(ts," in p for p in pushed), pushed


def test_columns_pruned_at_scan(spark):
    plan = _plan(scaled_effects(economic_events(spark, SF_SMALL)).select("event_id", "scaled_spread_multiplier"))
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan)[0]
    assert "props" not in schema and "value" not in schema, schema
    assert "EqualTo(event_type,error)" in plan


def test_no_python_evaluation_or_nested_loops(spark):
    skip = {"scan_parquet", "roundtrip_partitioned", "partition_counts", "orc_roundtrip", "upsert_merge",
            "stream_ingest", "stream_candles_1h", "stream_dedup", "stream_events", "upsert_all_grains",
            "table_file_rows", "compact_ticks"}
    for k, fn in registry.queries().items():
        if k in skip:
            continue
        plan = _plan(fn(spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
            assert bad not in plan, (k, bad)


def test_date_partitions_pruned_for_incremental_and_recent(spark):
    import datetime as dt

    from candlewick.operators.staging import recent
    from candlewick.session import scratch_path
    from candlewick.sources.files import write_ticks
    path = scratch_path(spark, "pruning")
    write_ticks(raw_ticks(spark, SF_SMALL), path)
    ticks = spark.read.parquet(path)
    target = spark.createDataFrame([(dt.datetime(2024, 1, 20, 10),)], "candle_timestamp timestamp_ntz")
    sliced = INC.incremental_slice(ticks, target, "1h")
    plan = _plan(sliced)
    assert "PartitionFilters: [isnotnull(date" in plan and "(date#" in plan and ">= 2024-01-20" in plan, plan
    assert sliced.count() == ticks.where(F.col("transaction_timestamp") >= F.lit("2024-01-20 08:00:00")
                                         .cast("timestamp_ntz")).count()
    r = recent(ticks, dt.datetime(2024, 1, 25, 12), 120)
    assert ">= 2024-01-25" in _plan(r)
