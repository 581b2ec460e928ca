"""Multi-grain OHLC candles.

One parameterised builder replaces the four per-grain models.  A candle is
built in two steps:

* ``candle_state`` — one aggregation over ticks grouped by
  (grid bucket, pair, base, quote).  Every buffer is mergeable: first/last
  tick as ``min``/``max`` of a (ts, tick_id, price…) struct (deterministic
  tie-break, no sort, no window), sums and counts, and small sets for the
  distinct counts.  Spark runs it as partial + final ObjectHashAggregate with
  a single shuffle of one partial row per (task, group) — a hot pair/day is
  combined map-side.
* ``finalize_candles`` — pure projection to the public columns.

``rollup_candles`` merges finer states into a coarser grid with the same
buffers, so a roll-up equals a direct build by construction.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from candlewick.functions.columns import bucket, interval_minutes

KEYS = ["candle_timestamp", "currency_pair", "base_currency", "quote_currency"]

# buffer types are pinned so that merging states never widens them (a wider
# sum would change the scale Spark keeps when dividing for the averages)
VOL_SUM = DecimalType(28, 8)
SPREAD_SUM = DecimalType(18, 2)


@dataclass(frozen=True)
class CandleSpec:
    interval: str
    trader_types: bool = False   # num_trader_types column
    quotes: bool = False         # open/close bid/ask + spread_change_pct


CANDLE_SPECS = {
    "1min": CandleSpec("1min"),
    "5min": CandleSpec("5min"),
    "1h": CandleSpec("1h", trader_types=True),
    "1d": CandleSpec("1d", trader_types=True, quotes=True),
}


def candle_spec(interval: str) -> CandleSpec:
    interval_minutes(interval)  # validates
    return CANDLE_SPECS.get(interval, CandleSpec(interval))


def _edge(quotes: bool):
    fields = [F.col("transaction_timestamp").alias("ts"), F.col("tick_id").alias("id"),
              F.col("trade_price").alias("price")]
    if quotes:
        fields += [F.col("bid_price").alias("bid"), F.col("ask_price").alias("ask")]
    return F.struct(*fields)


def candle_aggregates(spec: CandleSpec) -> list:
    """The mergeable buffers of a candle, for batch and streaming builds alike."""
    edge = _edge(spec.quotes)
    aggs = [
        F.min("trade_price").alias("low_price"),
        F.max("trade_price").alias("high_price"),
        F.min(edge).alias("_first"),
        F.max(edge).alias("_last"),
        F.sum("volume").cast(VOL_SUM).alias("_vol_sum"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("spread_bps").cast(SPREAD_SUM).alias("_spread_sum"),
        F.count("spread_bps").alias("_spread_n"),
        F.min("spread_bps").alias("min_spread_bps"),
        F.max("spread_bps").alias("max_spread_bps"),
        F.collect_set("exchange_location").alias("_exchanges"),
        F.min("transaction_timestamp").alias("period_start"),
        F.max("transaction_timestamp").alias("period_end"),
    ]
    if spec.trader_types:
        aggs.append(F.collect_set("trader_type").alias("_traders"))
    return aggs


def candle_state(ticks: DataFrame, interval: str, spec: CandleSpec | None = None) -> DataFrame:
    """Mergeable per-candle buffers (hidden ``_`` columns)."""
    return (ticks.groupBy(bucket("transaction_timestamp", interval).alias("candle_timestamp"),
                          "currency_pair", "base_currency", "quote_currency")
            .agg(*candle_aggregates(spec or candle_spec(interval))))


def _set_union(col: str):
    # sets are small (bounded by the value domain); collect_set of sets first
    # de-duplicates identical sets, flatten + array_distinct merges them
    return F.array_distinct(F.flatten(F.collect_set(col))).alias(col)


def merge_states(state: DataFrame, interval: str, spec: CandleSpec | None = None) -> DataFrame:
    """Re-aggregate finer candle states onto a coarser grid."""
    spec = spec or candle_spec(interval)
    aggs = [
        F.min("low_price").alias("low_price"), F.max("high_price").alias("high_price"),
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.sum("_vol_sum").cast(VOL_SUM).alias("_vol_sum"), F.sum("_n").alias("_n"),
        F.sum("_spread_sum").cast(SPREAD_SUM).alias("_spread_sum"), F.sum("_spread_n").alias("_spread_n"),
        F.min("min_spread_bps").alias("min_spread_bps"), F.max("max_spread_bps").alias("max_spread_bps"),
        _set_union("_exchanges"),
        F.min("period_start").alias("period_start"), F.max("period_end").alias("period_end"),
    ]
    if spec.trader_types:
        if "_traders" not in state.columns:
            raise ValueError("finer state lacks trader types; build it with trader_types=True")
        aggs.append(_set_union("_traders"))
    if spec.quotes and "bid" not in state.schema["_first"].dataType.fieldNames():
        raise ValueError("finer state lacks bid/ask; build it with quotes=True")
    return (state.groupBy(bucket("candle_timestamp", interval).alias("candle_timestamp"),
                          "currency_pair", "base_currency", "quote_currency")
            .agg(*aggs))


def finalize_candles(state: DataFrame, interval: str, spec: CandleSpec | None = None,
                     metrics: bool = True, calculated_at: bool = True) -> DataFrame:
    """Public candle columns, in the source model's order."""
    spec = spec or candle_spec(interval)
    cols = [F.col(k) for k in KEYS] + [
        F.col("low_price"), F.col("high_price"),
        F.col("_first.price").alias("open_price"), F.col("_last.price").alias("close_price")]
    if spec.quotes:
        cols += [F.col("_first.bid").alias("open_bid_price"), F.col("_first.ask").alias("open_ask_price"),
                 F.col("_last.bid").alias("close_bid_price"), F.col("_last.ask").alias("close_ask_price")]
    cols += [
        F.col("_vol_sum").cast(VOL_SUM).alias("total_volume"),
        (F.col("_vol_sum") / F.col("_n")).cast(DecimalType(22, 12)).alias("avg_trade_volume"),
        F.col("_n").cast("long").alias("trade_count"),
        F.when(F.col("_spread_n") > 0, F.col("_spread_sum") / F.col("_spread_n"))
         .cast(DecimalType(12, 6)).alias("avg_spread_bps"),
        F.col("min_spread_bps"), F.col("max_spread_bps"),
        F.size("_exchanges").cast("long").alias("num_exchanges"),
    ]
    if spec.trader_types:
        cols.append(F.size("_traders").cast("long").alias("num_trader_types"))
    cols += [F.col("period_start"), F.col("period_end")]
    if calculated_at:
        cols.append(F.current_timestamp().alias("calculated_at"))
    out = state.select(*cols)
    if metrics:
        out = with_price_metrics(out)
        if spec.quotes:
            out = with_spread_change(out)
    return out.withColumn("candle_interval", F.lit(spec.interval))


def ohlc_candles(ticks: DataFrame, interval: str = "1min", metrics: bool = True,
                 calculated_at: bool = True, spec: CandleSpec | None = None) -> DataFrame:
    """OHLC candles of staged ticks at one grain (1min / 5min / 1h / 1d)."""
    spec = spec or candle_spec(interval)
    return finalize_candles(candle_state(ticks, interval, spec), interval, spec, metrics, calculated_at)


def rollup_candles(fine_state: DataFrame, interval: str, metrics: bool = True,
                   calculated_at: bool = True) -> DataFrame:
    """Coarser candles from a finer ``candle_state`` (no tick re-scan)."""
    spec = candle_spec(interval)
    return finalize_candles(merge_states(fine_state, interval, spec), interval, spec, metrics, calculated_at)


def multi_grain_candles(ticks: DataFrame, intervals=("1min", "5min", "1h", "1d"),
                        calculated_at: bool = True, reuse: str | None = "checkpoint") -> dict[str, DataFrame]:
    """All grains from ONE aggregation of the ticks: the finest grain's
    mergeable state (carrying every extra a coarser grain needs) is built
    once and the coarser grains are rolled up from it.

    Each grain prunes different state columns, so Spark would not share the
    aggregation between them by itself.  ``reuse="checkpoint"`` writes the
    state (one row per pair and minute, far smaller than the ticks) to the
    shared checkpoint folder once; ``"persist"`` keeps it in executor
    storage; ``None`` leaves four independent plans."""
    intervals = list(intervals)
    specs = [candle_spec(iv) for iv in intervals]
    finest = intervals[0]
    full = CandleSpec(finest, trader_types=any(sp.trader_types for sp in specs),
                      quotes=any(sp.quotes for sp in specs))
    state = candle_state(ticks, finest, full)
    if reuse == "checkpoint":
        from candlewick.session import checkpoint_dir
        checkpoint_dir(ticks.sparkSession)
        state = state.checkpoint(eager=True)
    elif reuse == "persist":
        state = state.persist()
    out = {finest: finalize_candles(state, finest, specs[0], calculated_at=calculated_at)}
    for iv in intervals[1:]:
        out[iv] = rollup_candles(state, iv, calculated_at=calculated_at)
    return out


def with_price_metrics(c: DataFrame) -> DataFrame:
    """price_change, price_change_pct, price_range, volatility_pct
    (ratios as doubles, NULL unless open > 0)."""
    o, cl = F.col("open_price"), F.col("close_price")
    hi, lo = F.col("high_price"), F.col("low_price")
    od = o.cast("double")
    return (c.withColumn("price_change", cl - o)
            .withColumn("price_change_pct", F.when(o > 0, (cl - o).cast("double") / od * F.lit(100.0)))
            .withColumn("price_range", hi - lo)
            .withColumn("volatility_pct", F.when(o > 0, (hi - lo).cast("double") / od * F.lit(100.0))))


def with_spread_change(c: DataFrame) -> DataFrame:
    """Intraday quoted-spread change in percent (NULL unless open spread > 0)."""
    open_sp = F.col("open_ask_price") - F.col("open_bid_price")
    close_sp = F.col("close_ask_price") - F.col("close_bid_price")
    return c.withColumn("spread_change_pct",
                        F.when(open_sp > 0, (close_sp - open_sp).cast("double") / open_sp.cast("double") * F.lit(100.0)))


def add_row_numbers(df: DataFrame, partition_cols, order_cols, prefix: str = "rn",
                    skew_safe: bool = True) -> DataFrame:
    """``rn_first`` / ``rn_last`` row numbers per partition in ``order_cols``
    (ascending / descending).

    Skew-safe form (default): ``rn_first`` is the balanced chunked sequence
    position, ``rn_last = group size - rn_first + 1`` with the group size from
    an aggregation joined back (one row per group on the small side, so AQE
    can split a hot group on the large side).  ``skew_safe=False`` gives the
    plain two-window form, one task per group."""
    partition_cols, order_cols = list(partition_cols), list(order_cols)
    if not skew_safe:
        asc = Window.partitionBy(*partition_cols).orderBy(*[F.col(c).asc() for c in order_cols])
        desc = Window.partitionBy(*partition_cols).orderBy(*[F.col(c).desc() for c in order_cols])
        return (df.withColumn(f"{prefix}_first", F.row_number().over(asc))
                .withColumn(f"{prefix}_last", F.row_number().over(desc)))
    from candlewick.operators.windows import null_safe_left_join, sequenced
    seq = sequenced(df, partition_cols, order_cols, name=f"{prefix}_first")
    sizes = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("_group_rows"))
    out = null_safe_left_join(seq, sizes, partition_cols)
    return (out.withColumn(f"{prefix}_last", (F.col("_group_rows") - F.col(f"{prefix}_first") + 1).cast("long"))
            .drop("_group_rows"))


def first_last_ticks(ticks: DataFrame, interval: str = "1min") -> DataFrame:
    """First and last tick of every (pair, bucket): the rows that
    ``rn_first = 1`` / ``rn_last = 1`` select, found by aggregation."""
    edge = F.struct(F.col("transaction_timestamp").alias("ts"), F.col("tick_id").alias("id"),
                    F.col("trade_price").alias("price"))
    g = (ticks.groupBy("currency_pair", bucket("transaction_timestamp", interval).alias("candle_timestamp"))
         .agg(F.min(edge).alias("f"), F.max(edge).alias("l")))
    return g.select("currency_pair", "candle_timestamp",
                    F.col("f.id").alias("first_tick_id"), F.col("f.ts").alias("first_ts"),
                    F.col("f.price").alias("first_price"),
                    F.col("l.id").alias("last_tick_id"), F.col("l.ts").alias("last_ts"),
                    F.col("l.price").alias("last_price"))
