"""Market statistics over ticks and candles (analyst queries and the
dataset checks of the source system's test-suite, as DataFrame operators)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.constants import (ANNUALIZATION_PERIODS, CORRELATION_THRESHOLD, CURRENCY_PAIRS,
                                  EXPECTED_TRADER_SHARE, MAX_TICK_GAP_MS, MINUTE_VOLATILITY_THRESHOLD,
                                  REALIZED_VOL_WINDOW,
                                  TICK_RATE_TOLERANCE, TICKS_PER_SECOND_PER_PAIR, TRADER_SHARE_TOLERANCE)
from candlewick.functions.columns import bucket, micros_between, ntz_lit
from candlewick.operators.events import with_pair_reference
from candlewick.operators.windows import DEFAULT_CHUNK, chunked_sequence, lag_across_chunks, max_gap, rolling_rows

TS = "transaction_timestamp"


def ticks_per_pair(raw: DataFrame) -> DataFrame:
    """Tick count, average bid (4 dp) and spread (2 dp) per pair."""
    return (raw.groupBy("currency_pair")
            .agg(F.count(F.lit(1)).alias("ticks"),
                 F.round(F.avg("bid_price"), 4).alias("avg_bid"),
                 F.round(F.avg("spread_bps"), 2).alias("avg_spread"))
            .orderBy(F.desc("ticks"), "currency_pair"))


def most_volatile_pair(candles: DataFrame, since=None) -> DataFrame:
    """Average candle volatility_pct per pair, highest first (optional start)."""
    c = candles if since is None else candles.where(F.col("candle_timestamp") > ntz_lit(since))
    g = c.groupBy("currency_pair").agg(F.avg("volatility_pct").alias("avg_volatility"))
    # at most one row per pair: the ranking window runs on a tiny table
    return g.withColumn("volatility_rank",
                        F.row_number().over(Window.orderBy(F.desc("avg_volatility"), "currency_pair")).cast("long"))


def hourly_volume(candles: DataFrame) -> DataFrame:
    """Total volume per hour from (1-minute) candles."""
    return (candles.groupBy(bucket("candle_timestamp", "1h").alias("hour"))
            .agg(F.sum("total_volume").alias("hourly_volume")).orderBy("hour"))


def share_by(df: DataFrame, col: str, expected: dict | None = None,
             tolerance: float = TRADER_SHARE_TOLERANCE) -> DataFrame:
    """Normalised value counts of ``col`` (NULL excluded) against expected
    shares +/- tolerance; expected values that never occur get share 0."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()  # scalar subquery, evaluated once
    shares = counts.select(col, "n", (F.col("n") / total).alias("share"))
    if expected is None:
        return shares
    exp = df.sparkSession.createDataFrame(list(expected.items()), f"{col} string, expected_share double")
    out = shares.join(F.broadcast(exp), col, "full_outer")  # both sides bounded by the value domain
    return out.select(col, F.coalesce("n", F.lit(0).cast("long")).alias("n"),
                      F.coalesce("share", F.lit(0.0)).alias("share"), "expected_share",
                      (F.abs(F.coalesce("share", F.lit(0.0)) - F.col("expected_share")) < F.lit(tolerance))
                      .alias("within_tolerance"))


def trader_type_share(df: DataFrame) -> DataFrame:
    return share_by(df, "trader_type", EXPECTED_TRADER_SHARE, TRADER_SHARE_TOLERANCE)


def spread_stats(ticks: DataFrame) -> DataFrame:
    """Spread min/max/mean per pair, non-positive spreads, and ticks outside
    the pair's configured band."""
    t = with_pair_reference(ticks, ["min_spread_bps", "max_spread_bps"])
    sp = F.col("spread_bps").cast("double")
    lo = F.col("ref_min_spread_bps") if "ref_min_spread_bps" in t.columns else F.col("min_spread_bps")
    hi = F.col("ref_max_spread_bps") if "ref_max_spread_bps" in t.columns else F.col("max_spread_bps")
    return (t.groupBy("currency_pair")
            .agg(F.min(sp).alias("min_spread"), F.max(sp).alias("max_spread"), F.avg(sp).alias("mean_spread"),
                 F.count(sp).alias("n"),
                 F.sum(F.when(sp <= 0, 1).otherwise(0)).cast("long").alias("non_positive"),
                 F.sum(F.when((sp < lo) | (sp > hi), 1).otherwise(0)).cast("long").alias("outside_band")))


def minute_volatility(ticks: DataFrame, interval: str = "1min",
                      threshold: float = MINUTE_VOLATILITY_THRESHOLD) -> DataFrame:
    """Sample std of mid per (bucket, pair); only buckets above ``threshold``."""
    g = (ticks.groupBy(bucket(TS, interval).alias("bucket_start"), "currency_pair")
         .agg(F.stddev_samp(F.col("mid_price").cast("double")).alias("volatility"),
              F.count(F.lit(1)).alias("n")))
    return g.where(F.col("volatility") > F.lit(threshold))


def pair_correlation(ticks: DataFrame, interval: str = "1min", pairs=None,
                     threshold: float = CORRELATION_THRESHOLD) -> DataFrame:
    """Pearson correlation of per-bucket mean mid between every two pairs that share a bucket.

    Any pair takes part; a list of ``pairs`` restricts them and gives their order within a row.  Bucket means meet in a join on the bucket, so a row
    meets the other pairs of its own bucket alone, and the co-moments of two pairs are partial
    aggregates that merge: nothing is pivoted and no list of pairs is held."""
    means = ticks if pairs is None else ticks.where(F.col("currency_pair").isin(list(pairs)))
    means = (means.where("currency_pair is not null").groupBy(bucket(TS, interval).alias("bucket_start"), "currency_pair")
             .agg(F.avg(F.col("mid_price").cast("double")).alias("mean")))
    order = F.col("currency_pair") if pairs is None else F.array_position(F.array(*[F.lit(p) for p in pairs]), F.col("currency_pair"))
    a = means.select("bucket_start", F.col("currency_pair").alias("pair_a"), F.col("mean").alias("a"), order.alias("_a"))
    b = means.select("bucket_start", F.col("currency_pair").alias("pair_b"), F.col("mean").alias("b"), order.alias("_b"))
    return (a.join(b, "bucket_start").where("_a < _b").groupBy("pair_a", "pair_b")
            .agg(F.corr("a", "b").alias("correlation"), F.sum(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1).otherwise(0)).cast("long").alias("n_buckets"))
            .withColumn("correlated", F.abs("correlation") > F.lit(threshold)))


def tick_rate(raw: DataFrame, pairs: int = len(CURRENCY_PAIRS),
              per_pair_rate: float = TICKS_PER_SECOND_PER_PAIR, tolerance: float = TICK_RATE_TOLERANCE) -> DataFrame:
    """Observed tick count against pairs x rate x observed duration."""
    g = raw.agg(F.count(F.lit(1)).alias("ticks"), F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"))
    dur = micros_between(F.col("first_ts"), F.col("last_ts")) / F.lit(1e6)
    exp = F.lit(float(pairs * per_pair_rate)) * F.col("duration_seconds")
    return (g.withColumn("duration_seconds", dur)
            .withColumn("expected_ticks", exp)
            .withColumn("relative_error", F.when(F.col("expected_ticks") > 0,
                                                 F.abs(F.col("ticks") - F.col("expected_ticks")) / F.col("expected_ticks")))
            .withColumn("within_tolerance", F.col("relative_error") < F.lit(tolerance)))


def tick_gaps(ticks: DataFrame, chunk: str = DEFAULT_CHUNK, n_chunks: int | None = None,
              max_gap_ms: int = MAX_TICK_GAP_MS) -> DataFrame:
    """Largest gap between consecutive ticks per pair and over all ticks,
    and whether it stays under ``max_gap_ms``."""
    per_pair = max_gap(ticks, ["currency_pair"], TS, chunk, n_chunks=n_chunks)
    overall = max_gap(ticks, [], TS, chunk, n_chunks=n_chunks).select(F.lit("ALL").alias("currency_pair"), "tick_count", "max_gap_us")
    return per_pair.unionByName(overall).withColumn("gap_ok", F.col("max_gap_us") < F.lit(max_gap_ms * 1000))


def boundary_gap(ticks: DataFrame, boundary: str = "1h", radius_seconds: int = 5) -> DataFrame:
    """Largest gap among ticks within +/- radius of every ``boundary`` grid
    instant (e.g. hourly file roll or a restart point).  Each tick belongs to
    at most one boundary window while the radius is under half the grain."""
    r = F.make_dt_interval(secs=F.lit(radius_seconds).cast("decimal(18,6)"))
    at = bucket(F.col(TS) + r, boundary)
    near = ticks.withColumn("boundary", at).where(F.col(TS) >= F.col("boundary") - r)
    return max_gap(near, ["boundary"], TS).withColumn("gap_ok", F.col("max_gap_us") < F.lit(MAX_TICK_GAP_MS * 1000))


def log_returns(ticks: DataFrame, price: str = "mid_price", chunk: str = DEFAULT_CHUNK,
                n_chunks: int | None = None) -> DataFrame:
    """ln(p_t) - ln(p_{t-1}) per pair in (ts, tick_id) order."""
    d = lag_across_chunks(ticks, ["currency_pair"], [TS, "tick_id"], [price], chunk, n_chunks=n_chunks)
    return d.withColumn("log_return", F.log(F.col(price).cast("double")) - F.log(F.col(f"prev_{price}").cast("double")))


def realized_vol(ticks: DataFrame, n: int = REALIZED_VOL_WINDOW, periods: int = ANNUALIZATION_PERIODS,
                 price: str = "mid_price", chunk: str = DEFAULT_CHUNK, block_rows: int = 100_000,
                 n_chunks: int | None = None) -> DataFrame:
    """Rolling realised volatility: population std of the log returns inside
    the last ``n`` prices, x sqrt(periods); the pair's configured volatility
    while fewer than two prices are known."""
    seq = chunked_sequence(ticks, ["currency_pair"], [TS, "tick_id"], [price], chunk, n_chunks=n_chunks)
    seq = seq.withColumn("log_return", F.log(F.col(price).cast("double")) - F.log(F.col(f"prev_{price}").cast("double")))
    rolled = rolling_rows(seq, ["currency_pair"], "seq", n - 1,
                          {"_std": F.stddev_pop("log_return")}, block_rows)
    cfg = with_pair_reference(rolled, ["volatility"])
    return cfg.withColumn("realized_volatility",
                          F.when(F.col("seq") < 2, F.col("pair_volatility"))
                          .otherwise(F.col("_std") * F.lit(math.sqrt(periods)))).drop("_std")


def latest_candles(candles: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most recent candles (pair breaks ties): TakeOrderedAndProject."""
    return candles.orderBy(F.desc("candle_timestamp"), F.asc("currency_pair")).limit(n)
