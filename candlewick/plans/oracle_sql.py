"""DuckDB SQL for the correctness gate.

Each entry is independent SQL over the pre-registered tables; the tick and
event fixtures are re-stated as CTEs (FIXTURES.md §3, §4).
"""

from __future__ import annotations

S = "(3 + event_id % 28)"

RAW = f"""raw AS (
  SELECT CAST(event_id AS VARCHAR) AS tick_id,
    ts AS transaction_timestamp,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE CASE user_id % 6
      WHEN 0 THEN 'ECR/MRT' WHEN 1 THEN 'ECR/LCR' WHEN 2 THEN 'ECR/AMC'
      WHEN 3 THEN 'MRT/LCR' WHEN 4 THEN 'MRT/AMC' ELSE 'LCR/AMC' END END AS currency_pair,
    CASE WHEN event_id % 97 = 0 THEN value*(1+{S}/20000.0e0) ELSE value*(1-{S}/20000.0e0) END AS bid_price,
    CASE WHEN event_id % 97 = 0 THEN value*(1-{S}/20000.0e0) ELSE value*(1+{S}/20000.0e0) END AS ask_price,
    value AS mid_price,
    CAST({S} AS DOUBLE) AS spread_bps,
    value*(1+(event_id % 13 - 6)*0.00005e0) AS trade_price,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
    CASE WHEN event_id % 89 = 7 THEN 'Asteroid_Market' ELSE CASE event_id % 4 WHEN 0 THEN 'Earth_FX_Hub' WHEN 1 THEN 'Mars_Central_Exchange'
      WHEN 2 THEN 'Lunar_Trading_Post' ELSE 'Asteroid_Belt_Hub' END END AS exchange_location,
    CASE event_type WHEN 'click' THEN 'institutional' WHEN 'view' THEN 'retail'
      WHEN 'purchase' THEN 'mining_corp' WHEN 'signup' THEN 'government' ELSE 'unknown' END AS trader_type,
    ts + to_seconds(event_id % 7) + CASE WHEN event_id % 13 = 5 THEN INTERVAL 6 HOUR ELSE INTERVAL 0 HOUR END AS event_time
  FROM events)"""

TYPED = """typed AS (
  SELECT CAST(tick_id AS VARCHAR) AS tick_id,
    CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp,
    CAST(event_time AS TIMESTAMP) AS event_time,
    left(currency_pair, 20) AS currency_pair,
    split_part(currency_pair, '/', 1) AS base_currency,
    split_part(currency_pair, '/', 2) AS quote_currency,
    CAST(bid_price AS DECIMAL(18,8)) AS bid_price,
    CAST(ask_price AS DECIMAL(18,8)) AS ask_price,
    CAST(mid_price AS DECIMAL(18,8)) AS mid_price,
    CAST(trade_price AS DECIMAL(18,8)) AS trade_price,
    CAST(spread_bps AS DECIMAL(8,2)) AS spread_bps,
    CAST(volume AS DECIMAL(18,8)) AS volume,
    left(exchange_location, 50) AS exchange_location,
    left(trader_type, 50) AS trader_type
  FROM raw)"""

STG = """stg AS (
  SELECT * FROM typed
  WHERE bid_price > 0 AND ask_price > 0 AND mid_price > 0 AND trade_price > 0
    AND volume > 0 AND ask_price >= bid_price
    AND transaction_timestamp IS NOT NULL AND currency_pair IS NOT NULL)"""

EVENTS = """ev AS (
  SELECT 'EV' || CAST(event_id AS VARCHAR) AS event_id,
    CASE user_id % 6 WHEN 0 THEN 'SOLAR_STORM' WHEN 1 THEN 'TRADE_TARIFF' WHEN 2 THEN 'OXYGEN_CRISIS'
      WHEN 3 THEN 'MINING_STRIKE' WHEN 4 THEN 'POLICY_CHANGE' ELSE 'SUPPLY_SHOCK' END AS event_type,
    ts AS event_timestamp, ts AS start_timestamp,
    ts + to_minutes(CAST(30 + event_id % 690 AS INTEGER)) AS end_timestamp,
    1 + event_id % 5 AS severity,
    CASE user_id % 6 WHEN 0 THEN ['MRT','AMC'] WHEN 1 THEN ['ECR','MRT','LCR'] WHEN 2 THEN ['MRT']
      WHEN 3 THEN ['AMC'] WHEN 4 THEN ['ECR','LCR'] ELSE ['MRT','AMC'] END AS affected_currencies,
    1 + (event_id % 5)*0.25e0 AS spread_multiplier,
    1 + (event_id % 4)*0.5e0 AS volatility_multiplier,
    0.5e0 + (event_id % 6)*0.25e0 AS volume_multiplier
  FROM events WHERE event_type = 'error')"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TICK_CTES = (RAW, TYPED, STG)

BUCKET_SQL = {
    "1min": "date_trunc('minute', transaction_timestamp)",
    "5min": "date_trunc('minute', transaction_timestamp) - (INTERVAL 1 MINUTE * (minute(transaction_timestamp) % 5))",
    "1h": "date_trunc('hour', transaction_timestamp)",
    "1d": "CAST(date_trunc('day', transaction_timestamp) AS TIMESTAMP)",
}

_EXTRA = {"1min": (False, False), "5min": (False, False), "1h": (True, False), "1d": (True, True)}


def candle_cte(interval: str, name: str = "candles", src: str = "stg") -> str:
    """Candle CTE: one GROUP BY per grid bucket; first / last tick through
    DuckDB's arg_min / arg_max keyed on (timestamp, tick id)."""
    traders, quotes = _EXTRA[interval]
    b = BUCKET_SQL[interval]
    key = "(transaction_timestamp, tick_id)"
    quote_cols = "".join(f",\n        {fn}({c}, {key}) AS {alias}" for fn, c, alias in (
        ("arg_min", "bid_price", "open_bid_price"), ("arg_min", "ask_price", "open_ask_price"),
        ("arg_max", "bid_price", "close_bid_price"), ("arg_max", "ask_price", "close_ask_price"))) if quotes else ""
    trader_col = ",\n        count(DISTINCT trader_type) AS num_trader_types" if traders else ""
    return f"""{name} AS (
      SELECT {b} AS candle_timestamp, currency_pair, base_currency, quote_currency,
        min(trade_price) AS low_price, max(trade_price) AS high_price,
        arg_min(trade_price, {key}) AS open_price,
        arg_max(trade_price, {key}) AS close_price{quote_cols},
        sum(volume) AS total_volume, avg(volume) AS avg_trade_volume, count(*) AS trade_count,
        avg(spread_bps) AS avg_spread_bps, min(spread_bps) AS min_spread_bps, max(spread_bps) AS max_spread_bps,
        count(DISTINCT exchange_location) AS num_exchanges{trader_col},
        min(transaction_timestamp) AS period_start, max(transaction_timestamp) AS period_end
      FROM {src}
      GROUP BY 1, currency_pair, base_currency, quote_currency)"""


def candle_select(interval: str, name: str = "candles") -> str:
    """Report projection of a candle CTE (doubles, ratios rounded to 6)."""
    traders, quotes = _EXTRA[interval]
    cols = ["candle_timestamp", "currency_pair", "base_currency", "quote_currency",
            "CAST(low_price AS DOUBLE) AS low_price", "CAST(high_price AS DOUBLE) AS high_price",
            "CAST(open_price AS DOUBLE) AS open_price", "CAST(close_price AS DOUBLE) AS close_price"]
    if quotes:
        cols += [f"CAST({c} AS DOUBLE) AS {c}" for c in
                 ("open_bid_price", "open_ask_price", "close_bid_price", "close_ask_price")]
    cols += ["CAST(total_volume AS DOUBLE) AS total_volume",
             "round(CAST(avg_trade_volume AS DOUBLE), 6) AS avg_trade_volume",
             "CAST(trade_count AS BIGINT) AS trade_count",
             "round(CAST(avg_spread_bps AS DOUBLE), 6) AS avg_spread_bps",
             "CAST(min_spread_bps AS DOUBLE) AS min_spread_bps",
             "CAST(max_spread_bps AS DOUBLE) AS max_spread_bps",
             "CAST(num_exchanges AS BIGINT) AS num_exchanges"]
    if traders:
        cols.append("CAST(num_trader_types AS BIGINT) AS num_trader_types")
    cols += ["period_start", "period_end",
             "CAST(close_price - open_price AS DOUBLE) AS price_change",
             "CASE WHEN open_price > 0 THEN CAST(close_price - open_price AS DOUBLE) / CAST(open_price AS DOUBLE) * 100.0 END AS price_change_pct",
             "CAST(high_price - low_price AS DOUBLE) AS price_range",
             "CASE WHEN open_price > 0 THEN CAST(high_price - low_price AS DOUBLE) / CAST(open_price AS DOUBLE) * 100.0 END AS volatility_pct"]
    if quotes:
        cols.append("CASE WHEN open_ask_price - open_bid_price > 0 THEN "
                    "CAST((close_ask_price - close_bid_price) - (open_ask_price - open_bid_price) AS DOUBLE)"
                    " / CAST(open_ask_price - open_bid_price AS DOUBLE) * 100.0 END AS spread_change_pct")
    cols.append(f"'{interval}' AS candle_interval")
    return "SELECT " + ",\n  ".join(cols) + f"\nFROM {name}"


def candles_sql(interval: str) -> str:
    return with_ctes(*TICK_CTES, candle_cte(interval)) + candle_select(interval)


PAIR_CFG = """cfg AS (SELECT currency_pair, CAST(lo AS DOUBLE) AS min_spread_bps, CAST(hi AS DOUBLE) AS max_spread_bps,
    CAST(vol AS DOUBLE) AS pair_volatility, primary_exchange FROM (VALUES
    ('ECR/MRT', 5, 20, 0.15, 'Mars_Central_Exchange'),
    ('ECR/LCR', 3, 15, 0.08, 'Lunar_Trading_Post'),
    ('ECR/AMC', 8, 30, 0.22, 'Asteroid_Market'),
    ('MRT/LCR', 5, 18, 0.12, 'Mars_Central_Exchange'),
    ('MRT/AMC', 7, 25, 0.18, 'Asteroid_Market'),
    ('LCR/AMC', 6, 22, 0.14, 'Lunar_Trading_Post'))
  t(currency_pair, lo, hi, vol, primary_exchange))"""

HOUR_LIST = ("(CAST([0.3, 0.2, 0.2, 0.2, 0.3, 0.4, 0.6, 0.8, 1.0, 1.2, 1.3, 1.4, 1.5, 1.5, 1.4, 1.3, 1.2, 1.0, "
             "0.8, 0.6, 0.5, 0.4, 0.3, 0.3] AS DOUBLE[]))")

ACTIVE = ("e.start_timestamp <= s.transaction_timestamp AND s.transaction_timestamp <= e.end_timestamp "
          "AND (list_contains(e.affected_currencies, s.base_currency) OR list_contains(e.affected_currencies, s.quote_currency))")


def check_sql(table: str, model: str, checks) -> str:
    """One SELECT per check returning (model, check, column, severity, failures)."""
    parts = []
    for c in checks:
        col = c.columns[0] if c.columns else None
        if c.name == "not_null":
            cond = f"{col} IS NULL"
        elif c.name == "accepted_values":
            vals = ", ".join("'" + v + "'" for v in c.values)
            cond = f"{col} IS NOT NULL AND {col} NOT IN ({vals})"
        elif c.name == "between":
            ors = []
            if c.low is not None:
                ors.append(f"{col} < {c.low!r}")
            if c.high is not None:
                ors.append(f"{col} > {c.high!r}")
            cond = f"{col} IS NOT NULL AND (" + " OR ".join(ors) + ")"
        elif c.name == "expression":
            cond = f"({c.expr}) IS NOT NULL AND NOT ({c.expr})"
        else:
            keys = ", ".join(c.columns)
            nn = " AND ".join(f"{k} IS NOT NULL" for k in c.columns)
            parts.append(f"SELECT '{model}' AS model, '{c.name}' AS \"check\", '{c.column}' AS \"column\", "
                         f"'{c.severity}' AS severity, CAST(count(*) AS BIGINT) AS failures FROM "
                         f"(SELECT {keys} FROM {table} WHERE {nn} GROUP BY {keys} HAVING count(*) > 1)")
            continue
        parts.append(f"SELECT '{model}' AS model, '{c.name}' AS \"check\", '{c.column}' AS \"column\", "
                     f"'{c.severity}' AS severity, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failures FROM {table}")
    return "\nUNION ALL\n".join(parts)
