"""Cleaning layer: typed staging, quality filter, rejects, de-duplication,
time/pair filters (all narrow, no shuffle except ``dedup_ticks``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import PRICE_DEC, SPREAD_DEC, _c, ntz_lit, since_predicate

PRICE_COLS = ("bid_price", "ask_price", "mid_price", "trade_price")


def _varchar(c: Column, n: int) -> Column:
    # an engine cast to varchar(n) truncates; Spark's does not
    return F.substring(c.cast("string"), 1, n)


def typed_ticks(raw: DataFrame, keep=()) -> DataFrame:
    """Cast + rename raw ticks to the staging types, split the pair symbol
    (``keep``: extra input columns carried along unchanged)."""
    pair = F.col("currency_pair").cast("string")
    return raw.select(*[F.col(k) for k in keep],
        F.col("tick_id").cast("string").alias("tick_id"),
        F.col("transaction_timestamp").cast("timestamp_ntz").alias("transaction_timestamp"),
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        _varchar(pair, 20).alias("currency_pair"),
        F.split_part(pair, F.lit("/"), F.lit(1)).alias("base_currency"),
        F.split_part(pair, F.lit("/"), F.lit(2)).alias("quote_currency"),
        *[F.col(c).cast(PRICE_DEC).alias(c) for c in PRICE_COLS],
        F.col("spread_bps").cast(SPREAD_DEC).alias("spread_bps"),
        F.col("volume").cast(PRICE_DEC).alias("volume"),
        _varchar(F.col("exchange_location"), 50).alias("exchange_location"),
        _varchar(F.col("trader_type"), 50).alias("trader_type"),
    )


def quality_rules() -> list[tuple[str, Column]]:
    """reject reason -> predicate that must hold for a row to be kept"""
    return [
        ("bid_price_not_positive", F.col("bid_price") > 0),
        ("ask_price_not_positive", F.col("ask_price") > 0),
        ("mid_price_not_positive", F.col("mid_price") > 0),
        ("trade_price_not_positive", F.col("trade_price") > 0),
        ("volume_not_positive", F.col("volume") > 0),
        ("ask_below_bid", F.col("ask_price") >= F.col("bid_price")),
        ("timestamp_missing", F.col("transaction_timestamp").isNotNull()),
        ("pair_missing", F.col("currency_pair").isNotNull()),
    ]


def quality_predicate() -> Column:
    cond = None
    for _, rule in quality_rules():
        cond = rule if cond is None else cond & rule
    return cond


def quality_filter(typed: DataFrame) -> DataFrame:
    """Keep rows passing every rule (a NULL comparison drops the row;
    a NULL spread is kept)."""
    return typed.where(quality_predicate())


def stage_ticks(raw: DataFrame) -> DataFrame:
    """Raw ticks -> typed, filtered staging ticks."""
    return quality_filter(typed_ticks(raw))


def rejected_ticks(raw: DataFrame) -> DataFrame:
    """Complement of ``stage_ticks`` with the list of failed rules."""
    typed = typed_ticks(raw)
    reasons = F.array_compact(F.array(*[
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in quality_rules()]))
    return (typed.withColumn("reject_reasons", reasons)
            .where(F.size("reject_reasons") > 0))


def dedup_ticks(df: DataFrame, keys=("tick_id",), order=("transaction_timestamp", "tick_id")) -> DataFrame:
    """Keep one row per key (the first by ``order``).

    Keys are the tick id or a business key.  Implemented as an aggregate
    (``min`` over a struct whose leading fields are the order columns) so
    duplicates are combined map-side before the shuffle; a hot key costs one
    partial row per task, not one task for all its rows."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    ordered_rest = order + [c for c in rest if c not in order]
    picked = F.min(F.struct(*[F.col(c).alias(c) for c in ordered_rest])).alias("_row")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def dedup_ticks_window(df: DataFrame, keys=("tick_id",), order=("transaction_timestamp", "tick_id")) -> DataFrame:
    """Reference form: ``row_number() == 1`` per key (used in tests)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def recent(df: DataFrame, now, horizon_minutes: int, ts: str = "transaction_timestamp",
           pair: str | None = None, pair_col: str = "currency_pair") -> DataFrame:
    """Rows with ts > now - horizon (and optionally one pair).  ``now`` is a
    literal so the predicate reaches the Parquet scan."""
    now_c = ntz_lit(now)
    cond = _c(ts) > now_c - F.make_dt_interval(mins=F.lit(horizon_minutes))
    if isinstance(now, _dt.datetime) and isinstance(ts, str):
        # add the folder-level predicate when the table is date-partitioned
        cond = cond & since_predicate(df.columns, ts, now - _dt.timedelta(minutes=horizon_minutes))
    if pair is not None:
        cond = cond & (F.col(pair_col) == pair)
    return df.where(cond)
