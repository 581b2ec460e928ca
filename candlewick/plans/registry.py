"""Registered queries: key -> (spark, sf_dir) -> DataFrame, plus the DuckDB
oracle SQL for each key that has an SQL equivalent.

Every query reads the driver's tables (through the tick / event views) over
their whole extent.  Queries that exercise sinks write to a fresh folder
under the session's shared checkpoint folder and read the result back.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.constants import CURRENCY_PAIRS, EXCHANGES, TRADER_TYPES
from candlewick.functions.columns import (duration_minutes, impact_label, ntz_lit, pair_format_ok,
                                         partition_value, quote_from_mid, spread_bps)
from candlewick.operators import candles as C
from candlewick.operators import events as EV
from candlewick.operators import quality as Q
from candlewick.operators import staging as ST
from candlewick.operators import stats as SS
from candlewick.plans import incremental as INC
from candlewick.plans import oracle_sql as O
from candlewick.plans.report import candle_report, report
from candlewick.session import scratch_path
from candlewick.sources import files as FI
from candlewick.sources import fixtures as FX
from candlewick.sources import wire as W

Query = Callable[[SparkSession, str], DataFrame]

# fixed parameters of the registered incremental scenario
INITIAL_LOAD_END = _dt.datetime(2024, 1, 20, 10, 37, 30)   # first build sees ticks before this: mid-candle at every grain
SECOND_RUN_AT = _dt.datetime(2024, 1, 21)             # version time of the incremental run
FRESHNESS_NOW = _dt.datetime(2024, 1, 31)
BUSINESS_KEY = ("currency_pair", "transaction_timestamp", "bid_price", "ask_price", "trade_price", "volume")
TS = "transaction_timestamp"


def raw(spark, sf_dir):
    return FX.raw_ticks(spark, sf_dir)


def staged(spark, sf_dir):
    return ST.stage_ticks(raw(spark, sf_dir))


def events(spark, sf_dir):
    return FX.economic_events(spark, sf_dir)


def candles(spark, sf_dir, interval, **kw):
    return C.ohlc_candles(staged(spark, sf_dir), interval, **kw)


Q_: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        Q_[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


T = O.with_ctes(*O.TICK_CTES)
TR = O.with_ctes(O.RAW)
TT = O.with_ctes(O.RAW, O.TYPED)
TE = O.with_ctes(*O.TICK_CTES, O.EVENTS)
STG_COLS = """tick_id, transaction_timestamp, event_time, currency_pair, base_currency, quote_currency,
  CAST(bid_price AS DOUBLE) AS bid_price, CAST(ask_price AS DOUBLE) AS ask_price,
  CAST(mid_price AS DOUBLE) AS mid_price, CAST(trade_price AS DOUBLE) AS trade_price,
  CAST(spread_bps AS DOUBLE) AS spread_bps, CAST(volume AS DOUBLE) AS volume,
  exchange_location, trader_type"""
RAW_COLS = ("tick_id, transaction_timestamp, currency_pair, bid_price, ask_price, mid_price, spread_bps, "
            "trade_price, volume, exchange_location, trader_type, event_time")
WIRE_COLS = """tick_id, transaction_timestamp, currency_pair,
  CAST(CAST(bid_price AS DECIMAL(18,8)) AS DOUBLE) AS bid_price,
  CAST(CAST(ask_price AS DECIMAL(18,8)) AS DOUBLE) AS ask_price,
  CAST(CAST(mid_price AS DECIMAL(18,8)) AS DOUBLE) AS mid_price, spread_bps,
  CAST(CAST(trade_price AS DECIMAL(18,8)) AS DOUBLE) AS trade_price,
  CAST(CAST(volume AS DECIMAL(18,8)) AS DOUBLE) AS volume,
  exchange_location, trader_type, event_time"""


# =============================================================== staging
@register("stage_ticks", T + f"SELECT {STG_COLS} FROM stg")
def q_stage_ticks(spark, sf_dir):
    return report(staged(spark, sf_dir))


@register("parse_raw", TR + f"SELECT {WIRE_COLS} FROM raw")
def q_parse_raw(spark, sf_dir):
    """raw -> wire text (8-dp strings, ISO times) -> tolerant typed parse."""
    return W.parse_raw_ticks(W.to_wire(raw(spark, sf_dir)))


_REASONS = [("bid_price_not_positive", "bid_price > 0"), ("ask_price_not_positive", "ask_price > 0"),
            ("mid_price_not_positive", "mid_price > 0"), ("trade_price_not_positive", "trade_price > 0"),
            ("volume_not_positive", "volume > 0"), ("ask_below_bid", "ask_price >= bid_price"),
            ("timestamp_missing", "transaction_timestamp IS NOT NULL"), ("pair_missing", "currency_pair IS NOT NULL")]
_REASON_SQL = ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in _REASONS)


@register("rejected_ticks", TT + f"""SELECT tick_id, transaction_timestamp, currency_pair, reject_reasons FROM (
  SELECT *, concat_ws(',', {_REASON_SQL}) AS reject_reasons FROM typed) WHERE reject_reasons <> ''""")
def q_rejected_ticks(spark, sf_dir):
    r = ST.rejected_ticks(raw(spark, sf_dir))
    return r.select("tick_id", TS, "currency_pair", F.array_join("reject_reasons", ",").alias("reject_reasons"))


@register("spread_bps", TR + """SELECT tick_id, round(CASE WHEN mid_price > 0
    THEN (ask_price - bid_price) / mid_price * 10000 ELSE spread_bps END, 6) AS spread_bps_calc FROM raw""")
def q_spread_bps(spark, sf_dir):
    r = raw(spark, sf_dir)
    return r.select("tick_id", F.round(spread_bps("bid_price", "ask_price", "mid_price", "spread_bps"), 6)
                    .alias("spread_bps_calc"))


@register("quote_from_mid", TR + """SELECT tick_id,
    CAST(CAST(round_even(mid_price - mid_price * spread_bps / 20000.0, 8) AS DECIMAL(18,8)) AS DOUBLE) AS quoted_bid,
    CAST(CAST(round_even(mid_price + mid_price * spread_bps / 20000.0, 8) AS DECIMAL(18,8)) AS DOUBLE) AS quoted_ask
  FROM raw""")
def q_quote_from_mid(spark, sf_dir):
    bid, ask = quote_from_mid("mid_price", "spread_bps")
    return raw(spark, sf_dir).select("tick_id", bid.cast("double").alias("quoted_bid"),
                                     ask.cast("double").alias("quoted_ask"))


@register("pair_format", TR + """SELECT tick_id, currency_pair,
    regexp_full_match(currency_pair, '[^/]+/[^/]+') AS pair_format_ok FROM raw""")
def q_pair_format(spark, sf_dir):
    return raw(spark, sf_dir).select("tick_id", "currency_pair", pair_format_ok("currency_pair").alias("pair_format_ok"))


_BK = ", ".join(BUSINESS_KEY)


@register("dedup_ticks", T + f""", dup AS (SELECT * FROM stg UNION ALL SELECT * REPLACE ('replay-' || tick_id AS tick_id) FROM stg)
SELECT {STG_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY {_BK} ORDER BY transaction_timestamp, tick_id) AS rn FROM dup)
WHERE rn = 1""")
def q_dedup_ticks(spark, sf_dir):
    """A replay of every staged row under new ids; business-key de-dup keeps one."""
    s = staged(spark, sf_dir)
    replay = s.withColumn("tick_id", F.concat(F.lit("replay-"), "tick_id"))
    return report(ST.dedup_ticks(s.unionByName(replay), keys=BUSINESS_KEY))


@register("dedup_ticks_by_id", T + f"SELECT {STG_COLS} FROM stg")
def q_dedup_ticks_by_id(spark, sf_dir):
    """Every row redelivered a second later under its own id; the first delivery stays."""
    s = staged(spark, sf_dir)
    again = s.withColumn(TS, F.col(TS) + F.make_dt_interval(secs=F.lit(1)))
    return report(ST.dedup_ticks(s.unionByName(again)).select(s.columns))


@register("recent_ticks", T + f"""SELECT {STG_COLS} FROM stg WHERE currency_pair = 'ECR/MRT'
  AND transaction_timestamp > (SELECT max(transaction_timestamp) FROM stg) - INTERVAL 1 DAY""")
def q_recent_ticks(spark, sf_dir):
    s = staged(spark, sf_dir)
    now = s.agg(F.max(TS)).first()[0]   # one-row action -> literal, pushable filter
    return report(ST.recent(s, now, 24 * 60, pair="ECR/MRT"))


# =============================================================== events
@register("scaled_effects", O.with_ctes(O.EVENTS) + """SELECT event_id, severity, spread_multiplier, volatility_multiplier,
    1 + (spread_multiplier - 1) * severity / 5.0 AS scaled_spread_multiplier,
    1 + (volatility_multiplier - 1) * severity / 5.0 AS scaled_volatility_multiplier FROM ev""")
def q_scaled_effects(spark, sf_dir):
    return EV.scaled_effects(events(spark, sf_dir)).select(
        "event_id", "severity", "spread_multiplier", "volatility_multiplier",
        "scaled_spread_multiplier", "scaled_volatility_multiplier")


@register("event_duration", O.with_ctes(O.EVENTS) + """SELECT event_id, start_timestamp, end_timestamp,
    CAST(trunc(date_diff('microsecond', start_timestamp, end_timestamp) / 60000000.0) AS BIGINT) AS duration_minutes,
    severity, CASE severity WHEN 1 THEN 'Minor market disruption expected' WHEN 2 THEN 'Moderate volatility anticipated'
      WHEN 3 THEN 'Significant market impact likely' WHEN 4 THEN 'Major disruption to trading operations'
      WHEN 5 THEN 'Critical event with severe market consequences' END AS expected_impact FROM ev""")
def q_event_duration(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.select("event_id", "start_timestamp", "end_timestamp",
                    duration_minutes("start_timestamp", "end_timestamp").alias("duration_minutes"),
                    "severity", impact_label("severity").alias("expected_impact"))


@register("event_join", TE + f"""SELECT s.tick_id, s.currency_pair, s.transaction_timestamp, e.event_id, e.event_type,
    e.severity AS event_severity FROM stg s JOIN ev e ON {O.ACTIVE}""")
def q_event_join(spark, sf_dir):
    j = EV.active_events_join(staged(spark, sf_dir), events(spark, sf_dir))
    return j.select("tick_id", "currency_pair", TS, "event_id", "event_type", "event_severity")


@register("event_join_shuffle", TE + f"""SELECT s.tick_id, s.currency_pair, s.transaction_timestamp, e.event_id, e.event_type,
    e.severity AS event_severity FROM stg s JOIN ev e ON {O.ACTIVE}""")
def q_event_join_shuffle(spark, sf_dir):
    """Same join forced onto the shuffle path (event table above the bound)."""
    j = EV.active_events_join(staged(spark, sf_dir), events(spark, sf_dir), max_broadcast_rows=0)
    return j.select("tick_id", "currency_pair", TS, "event_id", "event_type", "event_severity")


_IMPACT_SQL = O.with_ctes(*O.TICK_CTES, O.EVENTS, O.PAIR_CFG) + f""", imp AS (
  SELECT s.tick_id, s.currency_pair, s.transaction_timestamp, CAST(count(e.event_id) AS BIGINT) AS active_events,
    coalesce(product(e.spread_multiplier), 1.0) AS spread_factor,
    coalesce(product(e.volatility_multiplier), 1.0) AS volatility_factor,
    coalesce(product(e.volume_multiplier), 1.0) AS volume_factor
  FROM stg s LEFT JOIN ev e ON {O.ACTIVE}
  GROUP BY s.tick_id, s.currency_pair, s.transaction_timestamp)
SELECT i.tick_id, i.currency_pair, i.transaction_timestamp, active_events, CAST(CAST(spread_factor AS FLOAT) AS DOUBLE) AS spread_factor,
  CAST(CAST(volatility_factor AS FLOAT) AS DOUBLE) AS volatility_factor, CAST(CAST(volume_factor AS FLOAT) AS DOUBLE) AS volume_factor,
  hour(i.transaction_timestamp) AS hour, {O.HOUR_LIST}[hour(i.transaction_timestamp) + 1] AS hour_volume_multiplier,
  {O.HOUR_LIST}[hour(i.transaction_timestamp) + 1] >= 1.2 AS is_peak_hour, c.pair_volatility,
  CAST(CAST(c.pair_volatility * {O.HOUR_LIST}[hour(i.transaction_timestamp) + 1] * volatility_factor AS FLOAT) AS DOUBLE) AS effective_volatility
FROM imp i LEFT JOIN cfg c ON i.currency_pair = c.currency_pair"""

_IMPACT_COLS = ["tick_id", "currency_pair", TS, "active_events", "spread_factor", "volatility_factor",
                "volume_factor", "hour", "hour_volume_multiplier", "is_peak_hour", "pair_volatility",
                "effective_volatility"]


def _impact_report(df: DataFrame) -> DataFrame:
    """Products in single precision: many events are active at once, and engines multiply them in their own order."""
    single = ("spread_factor", "volatility_factor", "volume_factor", "effective_volatility")
    return df.select(*[F.col(c).cast("float").cast("double").alias(c) if c in single else F.col(c) for c in _IMPACT_COLS])


@register("event_impact", _IMPACT_SQL)
def q_event_impact(spark, sf_dir):
    return _impact_report(EV.event_impact(staged(spark, sf_dir), events(spark, sf_dir)))


@register("event_impact_shuffle", _IMPACT_SQL)
def q_event_impact_shuffle(spark, sf_dir):
    """The sweep without a broadcast of the pairs."""
    return _impact_report(EV.event_impact(staged(spark, sf_dir), events(spark, sf_dir), max_broadcast_rows=0))


@register("event_impact_many_values", _IMPACT_SQL)
def q_event_impact_many_values(spark, sf_dir):
    """The way for multipliers of more distinct values than the sweep keeps counts for."""
    return _impact_report(EV.event_impact(staged(spark, sf_dir), events(spark, sf_dir), max_factor_values=0))


def _repeated(spark, sf_dir):
    s = staged(spark, sf_dir)
    return s.unionByName(s), events(spark, sf_dir).withColumn(
        "spread_multiplier", F.when(F.col("severity") != 3, F.col("spread_multiplier")))


_REPEATED_SQL = (_IMPACT_SQL.replace("product(e.spread_multiplier)", "product(CASE WHEN e.severity <> 3 THEN e.spread_multiplier END)")
                 + " JOIN (VALUES (1), (2)) twice(k) ON true")


@register("event_impact_repeated", _REPEATED_SQL)
def q_event_impact_repeated(spark, sf_dir):
    """Every tick twice, and events without a spread multiplier."""
    return _impact_report(EV.event_impact(*_repeated(spark, sf_dir)))


@register("event_impact_repeated_shuffle", _REPEATED_SQL)
def q_event_impact_repeated_shuffle(spark, sf_dir):
    return _impact_report(EV.event_impact(*_repeated(spark, sf_dir), max_broadcast_rows=0))


@register("hour_volume_profile", T + f"""SELECT tick_id, hour(transaction_timestamp) AS hour,
    {O.HOUR_LIST}[hour(transaction_timestamp) + 1] AS hour_volume_multiplier,
    {O.HOUR_LIST}[hour(transaction_timestamp) + 1] >= 1.2 AS is_peak_hour FROM stg""")
def q_hour_volume_profile(spark, sf_dir):
    return EV.with_hour_profile(staged(spark, sf_dir)).select("tick_id", "hour", "hour_volume_multiplier", "is_peak_hour")


@register("enrich_pairs", O.with_ctes(*O.TICK_CTES, O.PAIR_CFG) + """SELECT s.tick_id, s.currency_pair, c.primary_exchange,
    c.pair_volatility, c.min_spread_bps, c.max_spread_bps,
    CAST(s.spread_bps AS DOUBLE) BETWEEN c.min_spread_bps AND c.max_spread_bps AS spread_in_band
  FROM stg s LEFT JOIN cfg c ON s.currency_pair = c.currency_pair""")
def q_enrich_pairs(spark, sf_dir):
    e = EV.with_pair_reference(staged(spark, sf_dir))
    return e.select("tick_id", "currency_pair", "primary_exchange", "pair_volatility", "min_spread_bps", "max_spread_bps",
                    F.col("spread_bps").cast("double").between(F.col("min_spread_bps"), F.col("max_spread_bps"))
                    .alias("spread_in_band"))


@register("calendar_context", O.with_ctes(*O.TICK_CTES, O.EVENTS, O.candle_cte("1h")) + """SELECT c.candle_timestamp,
    c.currency_pair, e.event_id, e.event_type, e.event_timestamp FROM candles c JOIN ev e
  ON e.event_timestamp - INTERVAL 60 MINUTE <= c.candle_timestamp AND c.candle_timestamp <= e.event_timestamp + INTERVAL 60 MINUTE
  AND (list_contains(e.affected_currencies, c.base_currency) OR list_contains(e.affected_currencies, c.quote_currency))""")
def q_calendar_context(spark, sf_dir):
    c = candles(spark, sf_dir, "1h", metrics=False, calculated_at=False)
    j = EV.calendar_context(c, events(spark, sf_dir), minutes=60)
    return j.select("candle_timestamp", "currency_pair", "event_id", "event_type", "event_timestamp")


_TT = ", ".join(f"'{t}'" for t in TRADER_TYPES)
_EX = ", ".join(f"'{t}'" for t in EXCHANGES)


@register("orphan_trader_types", T + f"""SELECT tick_id, trader_type FROM stg
  WHERE trader_type IS NOT NULL AND trader_type NOT IN ({_TT})""")
def q_orphan_trader_types(spark, sf_dir):
    return Q.orphan_values(staged(spark, sf_dir), "trader_type", TRADER_TYPES).select("tick_id", "trader_type")


@register("orphan_exchanges", T + f"""SELECT tick_id, exchange_location FROM stg
  WHERE exchange_location IS NOT NULL AND exchange_location NOT IN ({_EX})""")
def q_orphan_exchanges(spark, sf_dir):
    return Q.orphan_values(staged(spark, sf_dir), "exchange_location", EXCHANGES).select("tick_id", "exchange_location")


# =============================================================== candles
def _candle_q(interval):
    def q(spark, sf_dir):
        return candle_report(candles(spark, sf_dir, interval))
    return q


for _iv in ("1min", "5min", "1h", "1d"):
    register(f"ohlc_{_iv}", O.candles_sql(_iv))(_candle_q(_iv))


@register("rollup_1h_from_1min", O.candles_sql("1h"))
def q_rollup_1h_from_1min(spark, sf_dir):
    fine = C.candle_state(staged(spark, sf_dir), "1min", C.CandleSpec("1min", trader_types=True))
    return candle_report(C.rollup_candles(fine, "1h"))


@register("rollup_1d_from_1h", O.candles_sql("1d"))
def q_rollup_1d_from_1h(spark, sf_dir):
    fine = C.candle_state(staged(spark, sf_dir), "1h", C.CandleSpec("1h", trader_types=True, quotes=True))
    return candle_report(C.rollup_candles(fine, "1d"))


def _all_grains_sql():
    ivs = ("1min", "5min", "1h", "1d")
    ctes = [O.candle_cte(iv, f"g_{i}") for i, iv in enumerate(ivs)]
    # by name: grains differ in their extra columns, missing ones become NULL
    return O.with_ctes(*O.TICK_CTES, *ctes) + "\nUNION ALL BY NAME\n".join(
        O.candle_select(iv, f"g_{i}") for i, iv in enumerate(ivs))


@register("ohlc_all_grains", _all_grains_sql())
def q_ohlc_all_grains(spark, sf_dir):
    """The four grains from one tick aggregation (1-minute state, rolled up)."""
    grains = C.multi_grain_candles(staged(spark, sf_dir))
    out = None
    for iv in ("1min", "5min", "1h", "1d"):
        df = candle_report(grains[iv])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


@register("first_last_ticks", O.with_ctes(*O.TICK_CTES, """o AS (
      SELECT currency_pair, date_trunc('minute', transaction_timestamp) AS candle_timestamp, tick_id,
        transaction_timestamp, trade_price,
        row_number() OVER (PARTITION BY currency_pair, date_trunc('minute', transaction_timestamp)
                           ORDER BY transaction_timestamp, tick_id) AS pos_asc,
        row_number() OVER (PARTITION BY currency_pair, date_trunc('minute', transaction_timestamp)
                           ORDER BY transaction_timestamp DESC, tick_id DESC) AS pos_desc
      FROM stg)""") + """SELECT f.currency_pair, f.candle_timestamp,
      f.tick_id AS first_tick_id, f.transaction_timestamp AS first_ts, CAST(f.trade_price AS DOUBLE) AS first_price,
      l.tick_id AS last_tick_id, l.transaction_timestamp AS last_ts, CAST(l.trade_price AS DOUBLE) AS last_price
    FROM o f JOIN o l ON f.currency_pair = l.currency_pair AND f.candle_timestamp = l.candle_timestamp
    WHERE f.pos_asc = 1 AND l.pos_desc = 1""")
def q_first_last_ticks(spark, sf_dir):
    return report(C.first_last_ticks(staged(spark, sf_dir), "1min"))


@register("add_row_numbers", T + """SELECT tick_id, currency_pair, transaction_timestamp,
    row_number() OVER (PARTITION BY currency_pair ORDER BY transaction_timestamp, tick_id) AS rn_first,
    row_number() OVER (PARTITION BY currency_pair ORDER BY transaction_timestamp DESC, tick_id DESC) AS rn_last FROM stg""")
def q_add_row_numbers(spark, sf_dir):
    ticks = staged(spark, sf_dir).select("tick_id", "currency_pair", TS)
    return C.add_row_numbers(ticks, ["currency_pair"], [TS, "tick_id"]).select(
        "tick_id", "currency_pair", TS, F.col("rn_first").cast("long").alias("rn_first"), F.col("rn_last").cast("long").alias("rn_last"))


@register("candle_metrics", "SELECT candle_timestamp, currency_pair, open_price, close_price, price_change, "
          "price_change_pct, price_range, volatility_pct FROM (" + O.candles_sql("1min") + ")")
def q_candle_metrics(spark, sf_dir):
    return candle_report(candles(spark, sf_dir, "1min")).select(
        "candle_timestamp", "currency_pair", "open_price", "close_price", "price_change", "price_change_pct",
        "price_range", "volatility_pct")


@register("spread_change", "SELECT candle_timestamp, currency_pair, open_bid_price, open_ask_price, close_bid_price, "
          "close_ask_price, spread_change_pct FROM (" + O.candles_sql("1d") + ")")
def q_spread_change(spark, sf_dir):
    return candle_report(candles(spark, sf_dir, "1d")).select(
        "candle_timestamp", "currency_pair", "open_bid_price", "open_ask_price", "close_bid_price",
        "close_ask_price", "spread_change_pct")


@register("latest_candles", O.with_ctes(*O.TICK_CTES, O.candle_cte("1min")) + O.candle_select("1min")
          + "\nORDER BY candle_timestamp DESC, currency_pair LIMIT 20")
def q_latest_candles(spark, sf_dir):
    return candle_report(SS.latest_candles(candles(spark, sf_dir, "1min"), 20))


_VIOL = " OR ".join(["low_price > open_price", "low_price > high_price", "low_price > close_price",
                     "high_price < open_price", "high_price < close_price", "open_price IS NULL",
                     "high_price IS NULL", "low_price IS NULL", "close_price IS NULL"])


@register("ohlc_violations", O.with_ctes(*O.TICK_CTES, *[O.candle_cte(iv, f"c_{i}") for i, iv in
                                                         enumerate(("1min", "5min", "1h", "1d"))])
          + "\nUNION ALL\n".join(
              f"SELECT 'ohlc_candles_{iv}' AS model_name, currency_pair, candle_timestamp, CAST(open_price AS DOUBLE) AS open_price, "
              f"CAST(high_price AS DOUBLE) AS high_price, CAST(low_price AS DOUBLE) AS low_price, "
              f"CAST(close_price AS DOUBLE) AS close_price FROM c_{i} WHERE {_VIOL}"
              for i, iv in enumerate(("1min", "5min", "1h", "1d"))))
def q_ohlc_violations(spark, sf_dir):
    grains = C.multi_grain_candles(staged(spark, sf_dir), calculated_at=False)   # one tick scan
    return report(Q.ohlc_violations({f"ohlc_candles_{iv}": df for iv, df in grains.items()}))


_BROKEN = "day(candle_timestamp) % 7 = 3"


@register("ohlc_violations_broken", O.with_ctes(*O.TICK_CTES, O.candle_cte("1h", "good"), f"""c AS (SELECT * REPLACE (
      CASE WHEN {_BROKEN} THEN NULL ELSE open_price END AS open_price,
      CASE WHEN trade_count % 5 = 4 THEN close_price + 1 ELSE low_price END AS low_price) FROM good)""")
          + f"""SELECT 'ohlc_candles_1h' AS model_name, currency_pair, candle_timestamp, CAST(open_price AS DOUBLE) AS open_price,
  CAST(high_price AS DOUBLE) AS high_price, CAST(low_price AS DOUBLE) AS low_price, CAST(close_price AS DOUBLE) AS close_price
  FROM c WHERE {_VIOL}""")
def q_ohlc_violations_broken(spark, sf_dir):
    """The invariants over a candle table in which some prices are lost or out of order."""
    c = candles(spark, sf_dir, "1h", metrics=False, calculated_at=False)
    broken = (c.withColumn("open_price", F.when(~F.expr(_BROKEN), F.col("open_price")))
              .withColumn("low_price", F.when(F.col("trade_count") % 5 == 4, F.col("close_price") + 1).otherwise(F.col("low_price"))))
    return report(Q.ohlc_violations({"ohlc_candles_1h": broken}))


# =============================================================== statistics
@register("ticks_per_pair", TR + """SELECT currency_pair, count(*) AS ticks, round(avg(bid_price), 4) AS avg_bid,
    round(avg(spread_bps), 2) AS avg_spread FROM raw GROUP BY currency_pair""")
def q_ticks_per_pair(spark, sf_dir):
    return SS.ticks_per_pair(raw(spark, sf_dir))


@register("most_volatile_pair", O.with_ctes(*O.TICK_CTES, O.candle_cte("1min")) + """, v AS (
    SELECT currency_pair, avg(CASE WHEN open_price > 0 THEN CAST(high_price - low_price AS DOUBLE) / CAST(open_price AS DOUBLE) * 100.0 END) AS a
    FROM candles GROUP BY currency_pair)
  SELECT currency_pair, round(a, 6) AS avg_volatility,
    row_number() OVER (ORDER BY a DESC, currency_pair) AS volatility_rank FROM v""")
def q_most_volatile_pair(spark, sf_dir):
    m = SS.most_volatile_pair(candles(spark, sf_dir, "1min", calculated_at=False))
    return m.select("currency_pair", F.round("avg_volatility", 6).alias("avg_volatility"), "volatility_rank")


@register("hourly_volume", O.with_ctes(*O.TICK_CTES, O.candle_cte("1min")) + """SELECT date_trunc('hour', candle_timestamp) AS hour,
    CAST(sum(total_volume) AS DOUBLE) AS hourly_volume FROM candles GROUP BY 1""")
def q_hourly_volume(spark, sf_dir):
    return report(SS.hourly_volume(candles(spark, sf_dir, "1min", metrics=False, calculated_at=False)))


@register("trader_type_share", TR + """, c AS (SELECT trader_type, count(*) AS n FROM raw WHERE trader_type IS NOT NULL GROUP BY 1),
  s AS (SELECT trader_type, n, n / (SELECT sum(n) FROM c) AS share FROM c),
  x AS (SELECT * FROM (VALUES ('institutional', 0.40::DOUBLE), ('retail', 0.35::DOUBLE), ('mining_corp', 0.15::DOUBLE),
        ('government', 0.10::DOUBLE)) t(trader_type, expected_share))
  SELECT trader_type, CAST(coalesce(n, 0) AS BIGINT) AS n, coalesce(share, 0.0) AS share, expected_share,
    abs(coalesce(share, 0.0) - expected_share) < 0.05 AS within_tolerance
  FROM s FULL OUTER JOIN x USING (trader_type)""")
def q_trader_type_share(spark, sf_dir):
    return SS.trader_type_share(raw(spark, sf_dir))


@register("spread_stats", O.with_ctes(O.RAW, O.PAIR_CFG) + """SELECT r.currency_pair, min(spread_bps) AS min_spread,
    max(spread_bps) AS max_spread, round(avg(spread_bps), 6) AS mean_spread, CAST(count(spread_bps) AS BIGINT) AS n,
    CAST(sum(CASE WHEN spread_bps <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS non_positive,
    CAST(sum(CASE WHEN spread_bps < c.min_spread_bps OR spread_bps > c.max_spread_bps THEN 1 ELSE 0 END) AS BIGINT) AS outside_band
  FROM raw r LEFT JOIN cfg c ON r.currency_pair = c.currency_pair GROUP BY r.currency_pair""")
def q_spread_stats(spark, sf_dir):
    return report(SS.spread_stats(raw(spark, sf_dir)), rounded=("mean_spread",))


def _vol_sql(trunc):
    return T + f"""SELECT date_trunc('{trunc}', transaction_timestamp) AS bucket_start, currency_pair,
    round(stddev_samp(CAST(mid_price AS DOUBLE)), 6) AS volatility, count(*) AS n FROM stg GROUP BY 1, 2
    HAVING stddev_samp(CAST(mid_price AS DOUBLE)) > 0.1"""


@register("minute_volatility", _vol_sql("minute"))
def q_minute_volatility(spark, sf_dir):
    return report(SS.minute_volatility(staged(spark, sf_dir), "1min"), rounded=("volatility",))


@register("hourly_volatility", _vol_sql("hour"))
def q_hourly_volatility(spark, sf_dir):
    return report(SS.minute_volatility(staged(spark, sf_dir), "1h"), rounded=("volatility",))


def _corr_sql():
    from itertools import combinations
    from candlewick.constants import CURRENCY_PAIRS as P
    cols = ",\n    ".join(f"avg(CASE WHEN currency_pair = '{p}' THEN CAST(mid_price AS DOUBLE) END) AS p{i}"
                          for i, p in enumerate(P))
    sel = "\nUNION ALL\n".join(
        f"SELECT '{P[a]}' AS pair_a, '{P[b]}' AS pair_b, round(corr(p{a}, p{b}), 6) AS correlation, "
        f"CAST(count(*) FILTER (WHERE p{a} IS NOT NULL AND p{b} IS NOT NULL) AS BIGINT) AS n_buckets, "
        f"abs(corr(p{a}, p{b})) > 0.1 AS correlated FROM w"
        for a, b in combinations(range(len(P)), 2))
    return T + f""", w AS (SELECT date_trunc('minute', transaction_timestamp) AS b,
    {cols}
  FROM stg GROUP BY 1)
""" + sel


@register("pair_correlation", _corr_sql())
def q_pair_correlation(spark, sf_dir):
    return report(SS.pair_correlation(staged(spark, sf_dir), "1min", pairs=CURRENCY_PAIRS), rounded=("correlation",))


@register("tick_rate", TR + """, g AS (SELECT count(*) AS ticks, min(transaction_timestamp) AS first_ts,
    max(transaction_timestamp) AS last_ts, date_diff('microsecond', min(transaction_timestamp), max(transaction_timestamp)) / 1e6 AS d FROM raw)
  SELECT ticks, first_ts, last_ts, d AS duration_seconds, 60.0 * d AS expected_ticks,
    CASE WHEN 60.0 * d > 0 THEN abs(ticks - 60.0 * d) / (60.0 * d) END AS relative_error,
    CASE WHEN 60.0 * d > 0 THEN abs(ticks - 60.0 * d) / (60.0 * d) END < 0.1 AS within_tolerance FROM g""")
def q_tick_rate(spark, sf_dir):
    return report(SS.tick_rate(raw(spark, sf_dir)))


@register("tick_gaps", T + """, g AS (SELECT currency_pair, transaction_timestamp AS t,
    lag(transaction_timestamp) OVER (PARTITION BY currency_pair ORDER BY transaction_timestamp, tick_id) AS p FROM stg),
  a AS (SELECT transaction_timestamp AS t, lag(transaction_timestamp) OVER (ORDER BY transaction_timestamp, tick_id) AS p FROM stg)
  SELECT currency_pair, count(*) AS tick_count, max(date_diff('microsecond', p, t)) AS max_gap_us,
    max(date_diff('microsecond', p, t)) < 200000 AS gap_ok FROM g GROUP BY 1
  UNION ALL SELECT 'ALL', count(*), max(date_diff('microsecond', p, t)), max(date_diff('microsecond', p, t)) < 200000 FROM a""")
def q_tick_gaps(spark, sf_dir):
    return SS.tick_gaps(staged(spark, sf_dir))


@register("boundary_gap", T + """, n AS (SELECT date_trunc('hour', transaction_timestamp + INTERVAL 300 SECOND) AS boundary,
    transaction_timestamp, tick_id FROM stg
    WHERE transaction_timestamp >= date_trunc('hour', transaction_timestamp + INTERVAL 300 SECOND) - INTERVAL 300 SECOND),
  g AS (SELECT boundary, transaction_timestamp AS t,
    lag(transaction_timestamp) OVER (PARTITION BY boundary ORDER BY transaction_timestamp, tick_id) AS p FROM n)
  SELECT boundary, count(*) AS tick_count, max(date_diff('microsecond', p, t)) AS max_gap_us,
    max(date_diff('microsecond', p, t)) < 200000 AS gap_ok FROM g GROUP BY 1""")
def q_boundary_gap(spark, sf_dir):
    """Gaps within +/- 300 s of every hourly file-roll boundary."""
    return SS.boundary_gap(staged(spark, sf_dir), "1h", 300)


@register("log_returns", T + """SELECT tick_id, currency_pair, transaction_timestamp,
    round(ln(CAST(mid_price AS DOUBLE)) - ln(CAST(lag(mid_price) OVER (PARTITION BY currency_pair
      ORDER BY transaction_timestamp, tick_id) AS DOUBLE)), 9) AS log_return FROM stg""")
def q_log_returns(spark, sf_dir):
    lr = SS.log_returns(staged(spark, sf_dir).select("tick_id", "currency_pair", TS, "mid_price"))
    return lr.select("tick_id", "currency_pair", TS, F.round("log_return", 9).alias("log_return"))


@register("realized_vol", O.with_ctes(*O.TICK_CTES, O.PAIR_CFG) + """, lr AS (
    SELECT tick_id, currency_pair, transaction_timestamp,
      ln(CAST(mid_price AS DOUBLE)) - ln(CAST(lag(mid_price) OVER w AS DOUBLE)) AS r, row_number() OVER w AS seq
    FROM stg WINDOW w AS (PARTITION BY currency_pair ORDER BY transaction_timestamp, tick_id)),
  v AS (SELECT *, stddev_pop(r) OVER (PARTITION BY currency_pair ORDER BY transaction_timestamp, tick_id
      ROWS BETWEEN 98 PRECEDING AND CURRENT ROW) AS sd FROM lr)
  SELECT v.tick_id, v.currency_pair, v.transaction_timestamp, CAST(v.seq AS BIGINT) AS seq,
    round(CASE WHEN v.seq < 2 THEN c.pair_volatility ELSE v.sd * sqrt(6048.0) END, 6) AS realized_volatility
  FROM v LEFT JOIN cfg c ON v.currency_pair = c.currency_pair""")
def q_realized_vol(spark, sf_dir):
    rv = SS.realized_vol(staged(spark, sf_dir).select("tick_id", "currency_pair", TS, "mid_price"))
    return rv.select("tick_id", "currency_pair", TS, "seq", F.round("realized_volatility", 6).alias("realized_volatility"))


# =============================================================== quality
def _candle_contract_sql(interval: str, table: str) -> str:
    """The candle contract as SQL of its own (not from ``candle_checks``)."""
    model, rows = f"ohlc_candles_{interval}", []

    def add(check, column, bad):
        rows.append(f"SELECT '{model}' AS model, '{check}' AS \"check\", '{column}' AS \"column\", 'error' AS severity, "
                    f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS failures FROM {table}")

    wide = interval == "1min"
    for c in ("candle_timestamp", "currency_pair", "open_price", "high_price", "low_price", "close_price", "total_volume"):
        add("not_null", c, f"{c} IS NULL")
    add("accepted_values", "candle_interval", f"candle_interval NOT IN ('{interval}')")
    rows.append(f"SELECT '{model}' AS model, 'unique_combination' AS \"check\", 'currency_pair,candle_timestamp' AS \"column\", "
                f"'error' AS severity, CAST(count(*) AS BIGINT) AS failures FROM (SELECT 1 FROM {table} "
                "WHERE currency_pair IS NOT NULL AND candle_timestamp IS NOT NULL "
                "GROUP BY currency_pair, candle_timestamp HAVING count(*) > 1)")
    if wide:
        for c in ("base_currency", "quote_currency", "trade_count", "calculated_at"):
            add("not_null", c, f"{c} IS NULL")
        add("accepted_values", "currency_pair", "currency_pair NOT IN ('ECR/MRT', 'ECR/LCR', 'ECR/AMC', 'MRT/LCR', 'MRT/AMC', 'LCR/AMC')")
        add("between", "open_price", "open_price < 0.0001 OR open_price > 1000000")
        add("between", "total_volume", "total_volume < 0")
        for rule in ("low_price <= high_price", "low_price <= open_price", "low_price <= close_price", "high_price >= open_price"):
            add("expression", rule, f"NOT ({rule})")
    return "\nUNION ALL\n".join(rows)


GRAINS = ("1min", "5min", "1h", "1d")


def _dq_sql():
    parts = [O.check_sql("raw", "raw_ticks", Q.source_checks()), O.check_sql("stg", "stg_fx_ticks", Q.staging_checks())]
    ctes = []
    for k, iv in enumerate(GRAINS):
        ctes += [O.candle_cte(iv, f"g{k}"), f"c{k} AS (SELECT *, '{iv}' AS candle_interval, now() AS calculated_at FROM g{k})"]
        parts.append(_candle_contract_sql(iv, f"c{k}"))
    return O.with_ctes(*O.TICK_CTES, *ctes) + "\nUNION ALL\n".join(parts)


@register("dq_report", _dq_sql())
def q_dq_report(spark, sf_dir):
    r = raw(spark, sf_dir)
    out = Q.dq_report_ticks(r)   # source and staging checks read the ticks together
    for iv, c in C.multi_grain_candles(ST.stage_ticks(r)).items():
        out = out.unionByName(Q.dq_report(c, Q.candle_checks(iv), f"ohlc_candles_{iv}"))
    return out


@register("freshness", T + """SELECT max(event_time) AS max_loaded_at,
    date_diff('microsecond', max(event_time), TIMESTAMP '2024-01-31 00:00:00') / 60e6 AS age_minutes,
    CASE WHEN max(event_time) IS NULL THEN 'error'
      WHEN date_diff('microsecond', max(event_time), TIMESTAMP '2024-01-31 00:00:00') / 60e6 > 15 THEN 'error'
      WHEN date_diff('microsecond', max(event_time), TIMESTAMP '2024-01-31 00:00:00') / 60e6 > 5 THEN 'warn'
      ELSE 'pass' END AS status FROM stg""")
def q_freshness(spark, sf_dir):
    return Q.freshness(staged(spark, sf_dir), FRESHNESS_NOW)


@register("trade_outside_quote", T + """SELECT tick_id, currency_pair, CAST(bid_price AS DOUBLE) AS bid_price,
    CAST(ask_price AS DOUBLE) AS ask_price, CAST(trade_price AS DOUBLE) AS trade_price FROM stg
  WHERE NOT (trade_price BETWEEN bid_price AND ask_price)""")
def q_trade_outside_quote(spark, sf_dir):
    return report(Q.trade_outside_quote(staged(spark, sf_dir)).select(
        "tick_id", "currency_pair", "bid_price", "ask_price", "trade_price"))


# =============================================================== incremental
_T0 = "TIMESTAMP '2024-01-20 10:37:30'"
_CUT = f"((SELECT date_trunc('hour', max(transaction_timestamp)) FROM stg WHERE transaction_timestamp < {_T0}) - INTERVAL 120 MINUTE)"


@register("incremental_window", T + f"SELECT {STG_COLS} FROM stg WHERE transaction_timestamp >= {_CUT}")
def q_incremental_window(spark, sf_dir):
    s = staged(spark, sf_dir)
    target = C.ohlc_candles(s.where(F.col(TS) < ntz_lit(INITIAL_LOAD_END)), "1h", calculated_at=False)
    return report(INC.incremental_slice(s, target, "1h"))


@register("upsert_merge", O.candles_sql("1h"))
def q_upsert_merge(spark, sf_dir):
    """Initial build on early ticks, then an incremental run on all ticks,
    upserted into the partitioned table on disk: equals a full build."""
    s = staged(spark, sf_dir)
    path = scratch_path(spark, "ohlc_1h")
    INC.build_candles(spark, s.where(F.col(TS) < ntz_lit(INITIAL_LOAD_END)), path, "1h", full_refresh=True)
    INC.build_candles(spark, s, path, "1h")
    return candle_report(INC.read_partitioned(spark, path).drop("partition"))


@register("upsert_all_grains", _all_grains_sql())
def q_upsert_all_grains(spark, sf_dir):
    """All four candle tables built on early ticks, then maintained from one
    incremental slice and one aggregation: equals the full builds."""
    s = staged(spark, sf_dir)
    root = scratch_path(spark, "marts")
    INC.build_all_candles(spark, s.where(F.col(TS) < ntz_lit(INITIAL_LOAD_END)), root, full_refresh=True)
    paths = INC.build_all_candles(spark, s, root)
    out = None
    for iv in ("1min", "5min", "1h", "1d"):
        df = candle_report(INC.read_partitioned(spark, paths[iv]).drop("partition"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


@register("late_ticks", T + f"""SELECT currency_pair, date_trunc('minute', transaction_timestamp) AS candle_timestamp,
    count(*) AS late_ticks, max(event_time) AS last_arrival FROM stg
  WHERE transaction_timestamp < {_T0} - INTERVAL 5 MINUTE AND event_time > {_T0} GROUP BY 1, 2""")
def q_late_ticks(spark, sf_dir):
    cutoff = INITIAL_LOAD_END - _dt.timedelta(minutes=5)
    return INC.late_ticks(staged(spark, sf_dir), cutoff, INITIAL_LOAD_END)


def _history(spark, sf_dir):
    s = staged(spark, sf_dir)
    first = s.where(F.col(TS) < ntz_lit(INITIAL_LOAD_END))
    v1 = C.ohlc_candles(first, "1h", calculated_at=False).withColumn("calculated_at", ntz_lit(INITIAL_LOAD_END))
    v2 = (C.ohlc_candles(INC.incremental_slice(s, v1, "1h"), "1h", calculated_at=False)
          .withColumn("calculated_at", ntz_lit(SECOND_RUN_AT)))
    return v1.unionByName(v2)


_HIST_SQL = O.with_ctes(*O.TICK_CTES, f"s1 AS (SELECT * FROM stg WHERE transaction_timestamp < {_T0})",
                        f"s2 AS (SELECT * FROM stg WHERE transaction_timestamp >= {_CUT})",
                        O.candle_cte("1h", "h1", "s1"), O.candle_cte("1h", "h2", "s2"),
                        f"hist AS (SELECT *, {_T0} AS calculated_at FROM h1 "
                        "UNION ALL SELECT *, TIMESTAMP '2024-01-21 00:00:00' AS calculated_at FROM h2)")


@register("candles_as_of", _HIST_SQL + """, latest AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY currency_pair, candle_timestamp ORDER BY calculated_at DESC) AS rn FROM hist
    WHERE calculated_at <= TIMESTAMP '2024-01-21 00:00:00') WHERE rn = 1)
  SELECT candle_timestamp, currency_pair, CAST(open_price AS DOUBLE) AS open_price, CAST(close_price AS DOUBLE) AS close_price,
    CAST(high_price AS DOUBLE) AS high_price, CAST(low_price AS DOUBLE) AS low_price, CAST(trade_count AS BIGINT) AS trade_count,
    CAST(total_volume AS DOUBLE) AS total_volume, calculated_at FROM latest""")
def q_candles_as_of(spark, sf_dir):
    a = INC.candles_as_of(_history(spark, sf_dir), SECOND_RUN_AT)
    return report(a.select("candle_timestamp", "currency_pair", "open_price", "close_price", "high_price", "low_price",
                           "trade_count", "total_volume", "calculated_at"), drop=())


@register("candles_as_of_first", _HIST_SQL + """SELECT candle_timestamp, currency_pair,
    CAST(close_price AS DOUBLE) AS close_price, CAST(trade_count AS BIGINT) AS trade_count, calculated_at
  FROM hist WHERE calculated_at <= TIMESTAMP '2024-01-20 18:00:00'""")
def q_candles_as_of_first(spark, sf_dir):
    """Between the two versions: only the first one counts."""
    a = INC.candles_as_of(_history(spark, sf_dir), _dt.datetime(2024, 1, 20, 18))
    return report(a.select("candle_timestamp", "currency_pair", "close_price", "trade_count", "calculated_at"), drop=())


@register("revised_candles", _HIST_SQL + """SELECT a.currency_pair, a.candle_timestamp, CAST(a.trade_count AS BIGINT) AS first_count,
    CAST(b.trade_count AS BIGINT) AS revised_count FROM hist a JOIN hist b ON a.currency_pair = b.currency_pair
  AND a.candle_timestamp = b.candle_timestamp AND a.calculated_at < b.calculated_at WHERE a.trade_count <> b.trade_count""")
def q_revised_candles(spark, sf_dir):
    """Candles that the second run changed: the first load ended inside them."""
    h = _history(spark, sf_dir).select("currency_pair", "candle_timestamp", "trade_count", "calculated_at")
    old, new = (h.where(F.col("calculated_at") == ntz_lit(t)).drop("calculated_at") for t in (INITIAL_LOAD_END, SECOND_RUN_AT))
    both = old.withColumnRenamed("trade_count", "first_count").join(
        new.withColumnRenamed("trade_count", "revised_count"), ["currency_pair", "candle_timestamp"])
    return both.where("first_count <> revised_count")


@register("scd2_snapshot", _HIST_SQL + """SELECT currency_pair, candle_timestamp, CAST(close_price AS DOUBLE) AS close_price,
    calculated_at AS valid_from,
    lead(calculated_at) OVER (PARTITION BY currency_pair, candle_timestamp ORDER BY calculated_at) AS valid_to,
    lead(calculated_at) OVER (PARTITION BY currency_pair, candle_timestamp ORDER BY calculated_at) IS NULL AS is_current
  FROM hist""")
def q_scd2_snapshot(spark, sf_dir):
    h = INC.scd2(_history(spark, sf_dir), ["currency_pair", "candle_timestamp"], "calculated_at")
    return report(h.select("currency_pair", "candle_timestamp", "close_price", "valid_from", "valid_to", "is_current"),
                  drop=())


@register("candle_snapshots", _HIST_SQL + """SELECT calculated_at, count(*) AS rows_written,
    count(DISTINCT (currency_pair, candle_timestamp)) AS keys_touched,
    calculated_at = max(calculated_at) OVER () AS is_latest FROM hist GROUP BY calculated_at""")
def q_candle_snapshots(spark, sf_dir):
    return INC.snapshots(_history(spark, sf_dir))


# =============================================================== sources / sinks
@register("scan_parquet", TR + f"SELECT {RAW_COLS} FROM raw")
def q_scan_parquet(spark, sf_dir):
    """Write ticks in date/hour folders, read them back recursively."""
    path = scratch_path(spark, "ticks")
    FI.write_ticks(raw(spark, sf_dir), path)
    return FI.read_tick_files(spark, path).select(*[c.strip() for c in RAW_COLS.split(",")])


@register("roundtrip_partitioned", TR + f"""SELECT {RAW_COLS}, CAST(transaction_timestamp AS DATE) AS date,
    CAST(hour(transaction_timestamp) AS BIGINT) AS hour FROM raw""")
def q_roundtrip_partitioned(spark, sf_dir):
    path = scratch_path(spark, "ticks_part")
    FI.write_ticks(raw(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.select(*[c.strip() for c in RAW_COLS.split(",")], F.col("date").cast("date").alias("date"),
                       F.col("hour").cast("long").alias("hour"))


@register("partition_counts", O.with_ctes(*O.TICK_CTES, O.candle_cte("5min")) + """SELECT
    strftime(candle_timestamp, '%Y-%m-%d') AS partition, count(*) AS record_count FROM candles GROUP BY 1""")
def q_partition_counts(spark, sf_dir):
    c = candles(spark, sf_dir, "5min", calculated_at=False)
    part = FI.partition_col("5min")
    c = c.withColumn("partition", partition_value("candle_timestamp", part))
    path = scratch_path(spark, "ohlc_5min")
    FI.materialize(c, path, partition_by="partition", sort_by=["currency_pair", "candle_timestamp"])
    back = spark.read.schema(c.schema).parquet(path)   # declared schema: partition stays a string
    return FI.table_partitions(back, "partition")


@register("orc_roundtrip", O.candles_sql("1d"))
def q_orc_roundtrip(spark, sf_dir):
    c = candles(spark, sf_dir, "1d", calculated_at=False)
    path = scratch_path(spark, "ohlc_1d_orc")
    FI.materialize(c, path, fmt="orc", sort_by=["currency_pair", "candle_timestamp"])
    return candle_report(spark.read.orc(path))


@register("compact_ticks", TR + f"SELECT {RAW_COLS}, strftime(transaction_timestamp, '%Y-%m') AS partition FROM raw")
def q_compact_ticks(spark, sf_dir):
    """Ticks landed as many small files (one per stream roll), compacted into
    few range-partitioned files, read back: same rows."""
    path = scratch_path(spark, "ticks_small_files")
    r = raw(spark, sf_dir).withColumn("partition", F.date_format(TS, "yyyy-MM"))
    r.repartition(32).write.partitionBy("partition").parquet(path)
    FI.compact(spark, path, "partition", [x[0] for x in r.select("partition").distinct().collect()],
               sort_by=[TS])
    return INC.read_partitioned(spark, path).select(*[c.strip() for c in RAW_COLS.split(",")], "partition")


@register("tick_to_json")
def q_tick_to_json(spark, sf_dir):
    return W.to_kafka_records(raw(spark, sf_dir))


@register("tick_to_json_fields", TR + f"SELECT currency_pair AS key, {WIRE_COLS} FROM raw")
def q_tick_to_json_fields(spark, sf_dir):
    """Keyed JSON records, decoded again field by field."""
    records = W.to_kafka_records(raw(spark, sf_dir)).select("key", F.from_json("value", W.WIRE_TICK).alias("w"))
    fields = W.parse_raw_ticks(records.where(F.col("key").eqNullSafe(F.col("w.currency_pair"))).select("w.*"))
    return fields.select(F.col("currency_pair").alias("key"), *[c.strip() for c in RAW_COLS.split(",")])


@register("ticks_by_key", TR + "SELECT currency_pair, count(*) AS ticks, CAST(1 AS BIGINT) AS partitions FROM raw GROUP BY 1")
def q_ticks_by_key(spark, sf_dir):
    """The topic layout: every pair in a partition of its own hash."""
    dealt = FI.partition_by_key(raw(spark, sf_dir).select("currency_pair"), n=6).withColumn("p", F.spark_partition_id())
    # counted in two steps, so that nothing moves the rows again before the partitions are counted
    per = dealt.groupBy("currency_pair", "p").agg(F.count(F.lit(1)).alias("ticks"))
    return per.groupBy("currency_pair").agg(F.sum("ticks").alias("ticks"), F.count(F.lit(1)).alias("partitions"))


@register("table_file_rows", TR + """SELECT CAST(transaction_timestamp AS DATE) AS date, count(*) AS record_count FROM raw GROUP BY 1""")
def q_table_file_rows(spark, sf_dir):
    """The file listing of a date/hour table: rows of all files of a date."""
    path = scratch_path(spark, "ticks_files")
    FI.write_ticks(raw(spark, sf_dir), path)
    files = FI.table_files(spark.read.parquet(path))
    return (files.select(F.regexp_extract("file_path", "date=([0-9-]+)", 1).cast("date").alias("date"), "record_count")
            .groupBy("date").agg(F.sum("record_count").alias("record_count")))


@register("stream_ingest", TR + f"SELECT {WIRE_COLS}, CAST(transaction_timestamp AS DATE) AS transaction_date FROM raw")
def q_stream_ingest(spark, sf_dir):
    """Wire JSON files -> streaming parse -> partitioned Parquet sink
    (availableNow), read back."""
    from candlewick.streaming.ingest import ingest_ticks
    src, sink, ck = (scratch_path(spark, n) for n in ("wire", "raw_sink", "raw_ckpt"))
    W.to_wire(raw(spark, sf_dir)).write.json(src)
    q = ingest_ticks(spark, sink, ck, source_path=src, available_now=True)
    q.awaitTermination()
    back = spark.read.parquet(sink)
    return back.select(*[c.strip() for c in RAW_COLS.split(",")], "transaction_date")


def _time_ranges(spark, sf_dir, n=4):
    """The raw ticks in ``n`` contiguous time ranges, as a live feed lands them.  Only the n-1 bounds reach the driver."""
    r = raw(spark, sf_dir)
    bounds = r.select(F.percentile_approx(TS, [i / n for i in range(1, n)])).first()[0]
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        part = r
        if low is not None:
            part = part.where(F.col(TS) > ntz_lit(low))
        yield part if high is None else part.where(F.col(TS) <= ntz_lit(high))


@register("stream_candles_1h", O.candles_sql("1h"))
def q_stream_candles_1h(spark, sf_dir):
    """Streaming twin of the 1h build.  The stream takes up each landed time range as one micro-batch, however many
    files it has, goes on from its checkpoint, and upserts into the candle table."""
    from candlewick.streaming.candles import stream_candles
    from candlewick.streaming.ingest import read_tick_stream
    src, table, ck = (scratch_path(spark, n) for n in ("wire_c", "stream_ohlc_1h", "stream_ohlc_ckpt"))
    for part in _time_ranges(spark, sf_dir):
        W.to_wire(part).write.mode("append").json(src)
        ticks = ST.stage_ticks(W.parse_raw_ticks(read_tick_stream(spark, path=src)))
        stream_candles(ticks, "1h", table, ck, available_now=True).awaitTermination()
    return candle_report(INC.read_partitioned(spark, table).drop("partition"))


@register("stream_dedup", TR + f"SELECT {WIRE_COLS} FROM raw")
def q_stream_dedup(spark, sf_dir):
    """Every wire record delivered twice (at-least-once producer), the second time with the next range of its
    feed; the stream keeps one per tick_id."""
    from candlewick.streaming.ingest import dedup_stream, read_tick_stream
    src, sink, ck = (scratch_path(spark, n) for n in ("wire_dup", "dedup_sink", "dedup_ckpt"))
    span = raw(spark, sf_dir).agg(F.min(TS), F.max(TS)).first()
    hours = 1 + int((span[1] - span[0]).total_seconds() // 7200)   # a replay may come this much later
    before = None
    for part in _time_ranges(spark, sf_dir):
        W.to_wire(part if before is None else part.unionByName(before)).write.mode("append").json(src)
        parsed = W.parse_raw_ticks(read_tick_stream(spark, path=src))
        (dedup_stream(parsed, ["tick_id"], TS, f"{hours} hours").writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
        before = part
    return spark.read.parquet(sink)


@register("stream_events", O.with_ctes(O.EVENTS) + """SELECT event_id, event_type, event_timestamp, start_timestamp,
    end_timestamp, severity, array_to_string(affected_currencies, ',') AS affected_currencies,
    spread_multiplier, volatility_multiplier, volume_multiplier FROM ev""")
def q_stream_events(spark, sf_dir):
    """Economic events published as wire JSON, read back by the event stream
    source (availableNow) into a Parquet sink."""
    from candlewick.streaming.ingest import read_event_stream
    src, sink, ck = (scratch_path(spark, n) for n in ("events_wire", "events_sink", "events_ckpt"))
    W.events_to_wire(events(spark, sf_dir)).write.json(src)
    q = (read_event_stream(spark, path=src).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    back = spark.read.parquet(sink)
    return back.select("event_id", "event_type", "event_timestamp", "start_timestamp", "end_timestamp", "severity",
                       F.array_join("affected_currencies", ",").alias("affected_currencies"),
                       "spread_multiplier", "volatility_multiplier", "volume_multiplier")


def queries() -> dict[str, Query]:
    from candlewick.plans import registry_upkeep  # noqa: F401 - registers its own queries here
    return dict(Q_)


def oracle_sql() -> dict[str, str]:
    queries()
    return {k: v for k, v in SQL.items() if k in Q_}
