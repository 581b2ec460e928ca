"""Temp views under the source system's table names, so analyst SQL runs
unchanged through ``spark.sql`` (CREATE / SHOW / SELECT pass straight to
Spark's own SQL engine; nothing is parsed here)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from candlewick.operators.candles import ohlc_candles
from candlewick.operators.staging import stage_ticks
from candlewick.sources.fixtures import economic_events, raw_ticks


def register_views(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    """raw_ticks_streaming, stg_fx_ticks, ohlc_candles_{1min,5min,1h,1d}, economic_events."""
    raw = raw_ticks(spark, sf_dir)
    stg = stage_ticks(raw)
    views = {"raw_ticks_streaming": raw, "stg_fx_ticks": stg, "economic_events": economic_events(spark, sf_dir)}
    for iv in ("1min", "5min", "1h", "1d"):
        views[f"ohlc_candles_{iv}"] = ohlc_candles(stg, iv)
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
