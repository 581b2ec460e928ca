"""Streaming candles that keep every tick.

Ticks whose candle closed before they came go to a side table in place of being dropped: a candle is
closed when it ends at or before the latest event time of the micro-batches before, less ``delay``.
All other ticks become partial candle states, written by micro-batch; the candles that a batch touches are
merged from their partial states and upserted.  Everything a batch writes lies in folders of its own number
and depends on earlier batches alone, so a batch that is run again replaces what it had written.

Under ``root``: ``candles``, ``late`` (staged ticks with ``batch``), ``states`` and ``marks``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.constants import LOOKBACK_MINUTES
from candlewick.functions.columns import bucket, interval_minutes, ntz_lit, partition_value
from candlewick.operators.candles import KEYS as STATE_KEYS
from candlewick.operators.candles import candle_spec, candle_state, finalize_candles, merge_states
from candlewick.plans.incremental import KEYS, read_or_none, upsert_path
from candlewick.sources.files import partition_col

TS = "transaction_timestamp"


def _write_own(df: DataFrame, path: str, *by: str) -> None:
    if df.isEmpty():
        return  # a folder without a file has no schema to be read by
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def closed_before(spark: SparkSession, root: str, batch: int, delay_minutes: int):
    """Candles that end at or before this instant are closed for ``batch``; None before the first batch with ticks."""
    marks = read_or_none(spark, f"{root}/marks", "parquet", "batch")
    latest = marks and marks.where(F.col("batch").cast("long") < batch).agg(F.max("latest")).first()[0]
    return latest and latest - _dt.timedelta(minutes=delay_minutes)


def keep_batch(ticks: DataFrame, batch: int, interval: str, root: str, delay_minutes: int | None = None) -> None:
    """Take up one micro-batch of staged ticks."""
    spark, spec, part = ticks.sparkSession, candle_spec(interval), partition_col(interval)
    if delay_minutes is None:
        delay_minutes = LOOKBACK_MINUTES.get(interval, 0) + interval_minutes(interval)
    closed = closed_before(spark, root, batch, delay_minutes)
    end = bucket(TS, interval) + F.make_dt_interval(mins=F.lit(interval_minutes(interval)))
    is_late = F.lit(False) if closed is None else end <= ntz_lit(closed)
    own = F.lit(str(batch)).alias("batch")
    _write_own(ticks.where(is_late).select("*", own), f"{root}/late", "batch")
    states = candle_state(ticks.where(~is_late), interval, spec)
    states = states.select("*", partition_value("candle_timestamp", part).alias("partition"), own)
    _write_own(states, f"{root}/states", "partition", "batch")
    stored = read_or_none(spark, f"{root}/states", "parquet", "batch")
    if stored is not None:
        stored = stored.withColumn("partition", F.col("partition").cast("string"))
        mine = stored.where(F.col("batch") == str(batch)).select("partition", *STATE_KEYS)
        touched = [r[0] for r in mine.select("partition").distinct().collect()]  # folders, not rows
        same = stored.where(F.col("partition").isin(touched)).join(mine, ["partition", *STATE_KEYS], "left_semi")
        if touched:
            candles = finalize_candles(merge_states(same, interval, spec), interval, spec)
            upsert_path(spark, f"{root}/candles", candles.withColumn("partition", partition_value("candle_timestamp", part)), KEYS, "partition")
    _write_own(ticks.agg(F.max(TS).alias("latest")).where("latest is not null").select("latest", own), f"{root}/marks", "batch")


def stream_candles_keeping_late(ticks: DataFrame, interval: str, root: str, checkpoint: str, delay_minutes: int | None = None,
                                available_now: bool = False, trigger_seconds: int = 60):
    """Start a candle build over a stream of staged ticks in which no tick is lost: it is in a candle or in the side table."""

    def take_up(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # read for the side table, the states and the mark; recomputed from its source if lost
        try:
            keep_batch(batch, number, interval, root, delay_minutes)
        finally:
            batch.unpersist()

    w = ticks.writeStream.foreachBatch(take_up).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
