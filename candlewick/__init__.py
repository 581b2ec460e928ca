"""candlewick — tick ingestion, cleaning, OHLC candles, event enrichment,
market statistics and data-quality checks, written as Spark DataFrame and
Structured Streaming code (no Python UDFs).

The most used entry points are re-exported here; everything else lives in
``functions``, ``sources``, ``operators``, ``plans`` and ``streaming``.
"""

from candlewick.session import cluster_profile, get_spark, scratch_path  # noqa: F401
from candlewick.operators.staging import dedup_ticks, rejected_ticks, stage_ticks  # noqa: F401
from candlewick.operators.candles import multi_grain_candles, ohlc_candles, rollup_candles  # noqa: F401
from candlewick.operators.events import active_events_join, event_impact  # noqa: F401
from candlewick.operators.quality import dq_report, run_checks  # noqa: F401
from candlewick.plans.incremental import build_all_candles, build_candles, upsert, upsert_path  # noqa: F401

__all__ = ["get_spark", "cluster_profile", "scratch_path", "stage_ticks", "rejected_ticks", "dedup_ticks",
           "ohlc_candles", "rollup_candles", "multi_grain_candles", "active_events_join", "event_impact",
           "dq_report", "run_checks", "build_candles", "build_all_candles", "upsert", "upsert_path"]
