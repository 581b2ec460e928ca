"""Registered queries of tables that are kept up from run to run: snapshots, appends, check states,
carried tails, late rows, live enrichment and run counters, each with its DuckDB oracle SQL."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.columns import ntz_lit, partition_value
from candlewick.operators import candles as C
from candlewick.operators import quality as Q
from candlewick.operators import staging as ST
from candlewick.operators import stats as SS
from candlewick.plans import colocated as CO
from candlewick.plans import incremental as INC
from candlewick.plans import oracle_sql as O
from candlewick.plans import snapshots as SN
from candlewick.plans import volatility as VOL
from candlewick.plans.registry import (INITIAL_LOAD_END, RAW_COLS, SQL, STG_COLS, TE, TR, TS, WIRE_COLS, T, _time_ranges, events, raw, register, staged)
from candlewick.plans.report import candle_report, report
from candlewick.session import scratch_path
from candlewick.sources import files as FI
from candlewick.sources import wire as W

_T0 = "TIMESTAMP '2024-01-20 10:37:30'"
CANDLE_KEY = ["currency_pair", "candle_timestamp"]

# ------------------------------------------------------------ snapshots
#: Three runs: early ticks, all ticks without one pair and with some corrected closes, all ticks again.
SNAPSHOT_RUNS = (INITIAL_LOAD_END, _dt.datetime(2024, 1, 31), _dt.datetime(2024, 2, 1))


def _snapshot_rows(ticks: DataFrame, corrected: bool = False) -> DataFrame:
    c = report(C.ohlc_candles(ticks, "1h", metrics=False, calculated_at=False)).select(*CANDLE_KEY, "close_price", "total_volume", "trade_count")
    if corrected:
        c = c.withColumn("close_price", F.when(F.hour("candle_timestamp") == 5, F.col("close_price") + 1).otherwise(F.col("close_price")))
    return c.withColumn("partition", partition_value("candle_timestamp", "day"))


_SNAPSHOT_SQL = O.with_ctes(
    *O.TICK_CTES, f"s1 AS (SELECT * FROM stg WHERE transaction_timestamp < {_T0})", "s2 AS (SELECT * FROM stg WHERE currency_pair <> 'LCR/AMC')",
    O.candle_cte("1h", "h1", "s1"), O.candle_cte("1h", "h2", "s2"), O.candle_cte("1h", "h3", "stg"),
    """runs AS (SELECT * FROM (VALUES (1, TIMESTAMP '2024-01-20 10:37:30'), (2, TIMESTAMP '2024-01-31'), (3, TIMESTAMP '2024-02-01')) v(run, run_at))""",
    """state AS (SELECT 1 AS run, currency_pair, candle_timestamp, CAST(close_price AS DOUBLE) AS close_price,
      CAST(total_volume AS DOUBLE) AS total_volume, CAST(trade_count AS BIGINT) AS trade_count FROM h1
    UNION ALL SELECT 2, currency_pair, candle_timestamp, CAST(close_price AS DOUBLE) + CASE WHEN hour(candle_timestamp) = 5 THEN 1 ELSE 0 END,
      CAST(total_volume AS DOUBLE), CAST(trade_count AS BIGINT) FROM h2
    UNION ALL SELECT 3, currency_pair, candle_timestamp, CAST(close_price AS DOUBLE), CAST(total_volume AS DOUBLE), CAST(trade_count AS BIGINT) FROM h3)""",
    "keys AS (SELECT DISTINCT currency_pair, candle_timestamp FROM state)",
    """seen AS (SELECT k.currency_pair, k.candle_timestamp, r.run, r.run_at, s.run IS NOT NULL AS present, s.close_price, s.total_volume, s.trade_count
    FROM keys k JOIN runs r ON true LEFT JOIN state s ON s.currency_pair = k.currency_pair AND s.candle_timestamp = k.candle_timestamp AND s.run = r.run)""",
    """steps AS (SELECT *, run = 1 OR present IS DISTINCT FROM lag(present) OVER w OR close_price IS DISTINCT FROM lag(close_price) OVER w
      OR total_volume IS DISTINCT FROM lag(total_volume) OVER w OR trade_count IS DISTINCT FROM lag(trade_count) OVER w AS changed
    FROM seen WINDOW w AS (PARTITION BY currency_pair, candle_timestamp ORDER BY run))""",
    """spans AS (SELECT *, lead(run_at) OVER (PARTITION BY currency_pair, candle_timestamp ORDER BY run) AS until FROM steps WHERE changed)""",
) + """SELECT currency_pair, candle_timestamp, close_price, total_volume, trade_count, run_at AS valid_from, until AS valid_to FROM spans WHERE present"""


@register("snapshot_three_runs", _SNAPSHOT_SQL)
def q_snapshot_three_runs(spark, sf_dir):
    """A type-2 table over three runs: new, changed and vanished keys, and keys that come back."""
    s, path = staged(spark, sf_dir), scratch_path(spark, "snapshot")
    tables = (_snapshot_rows(s.where(F.col(TS) < ntz_lit(INITIAL_LOAD_END))), _snapshot_rows(s.where("currency_pair <> 'LCR/AMC'"), True), _snapshot_rows(s))
    for at, rows in zip(SNAPSHOT_RUNS, tables, strict=True):
        SN.snapshot_run(spark, path, rows, CANDLE_KEY, at)
    return INC.read_partitioned(spark, path).select(*CANDLE_KEY, "close_price", "total_volume", "trade_count", "valid_from", "valid_to")


# ------------------------------------------------------------ co-located merge
@register("upsert_colocated", O.candles_sql("1h"))
def q_upsert_colocated(spark, sf_dir):
    """The incremental scenario on a table in buckets of its key: equals a full build."""
    s, table = staged(spark, sf_dir), f"candles_1h_{uuid.uuid4().hex[:12]}"
    build = lambda ticks: C.ohlc_candles(ticks, "1h", calculated_at=False).withColumn("partition", partition_value("candle_timestamp", "month"))
    CO.create_bucketed(build(s.where(F.col(TS) < ntz_lit(INITIAL_LOAD_END))), table)
    CO.upsert_bucketed(spark, table, build(INC.incremental_slice(s, spark.table(table), "1h")))
    return candle_report(spark.table(table).drop("partition"))


# ------------------------------------------------------------ appends
@register("append_redelivered", T + f"SELECT {STG_COLS} FROM stg")
def q_append_redelivered(spark, sf_dir):
    """Deliveries that hold the one before again and rows twice; one is cut off half-way and delivered again.  Every id is stored once."""
    path, before = scratch_path(spark, "appended"), None
    for k, part in enumerate(_time_ranges(spark, sf_dir)):
        ticks = ST.stage_ticks(part)
        batch = ticks.unionByName(ticks.where(F.xxhash64("tick_id") % 3 == 0))
        batch = batch if before is None else batch.unionByName(before)
        if k == 2:  # cut off: some of its rows are already there
            INC.append_new(spark, path, ticks.where(F.xxhash64("tick_id") % 2 == 0), f"b{k}")
        INC.append_new(spark, path, batch, f"b{k}")
        before = ticks
    return report(spark.read.parquet(path).select(staged(spark, sf_dir).columns))


# ------------------------------------------------------------ quality
def _incremental_dq_sql() -> str:
    candles = O.with_ctes(*O.TICK_CTES, O.candle_cte("1h", "g"), "c AS (SELECT *, '1h' AS candle_interval FROM g)")
    return candles + "\nUNION ALL\n".join((O.check_sql("raw", "raw_ticks", Q.source_checks()), O.check_sql("stg", "stg_fx_ticks", Q.staging_checks()),
                                           O.check_sql("c", "ohlc_candles_1h", Q.candle_checks("1h"))))


@register("dq_report_incremental", _incremental_dq_sql())
def q_dq_report_incremental(spark, sf_dir):
    """Check states of a first load, then of its changed folders alone, give the report of the whole tables."""
    def tables(ticks: DataFrame) -> dict:
        s = ST.stage_ticks(ticks)
        day = lambda df, ts: df.withColumn("partition", partition_value(ts, "day"))
        return {"raw_ticks": (day(ticks, TS), Q.source_checks()), "stg_fx_ticks": (day(s, TS), Q.staging_checks()),
                "ohlc_candles_1h": (day(C.ohlc_candles(s, "1h"), "candle_timestamp"), Q.candle_checks("1h"))}

    r, root = raw(spark, sf_dir), scratch_path(spark, "check_states")
    for model, (df, checks) in tables(r.where(F.col(TS) < ntz_lit(INITIAL_LOAD_END))).items():
        Q.refresh_check_states(df, checks, f"{root}/{model}")
    changed = r.where(F.col(TS) >= ntz_lit(INITIAL_LOAD_END)).select(partition_value(TS, "day").alias("p")).distinct()
    changed, out = [x[0] for x in changed.collect()], None  # folders, not rows
    for model, (df, checks) in tables(r).items():
        Q.refresh_check_states(df, checks, f"{root}/{model}", partitions=changed)
        part = Q.report_from_states(spark, f"{root}/{model}", checks, model)
        out = part if out is None else out.unionByName(part)
    return out


@register("check_severity", TR + "SELECT severity, CAST(count(*) AS BIGINT) AS checks, CAST(count(*) FILTER (WHERE failures > 0) AS BIGINT) AS failing, "
          "severity = 'error' AND count(*) FILTER (WHERE failures > 0) > 0 AS raises FROM (" + O.check_sql("raw", "raw_ticks", Q.source_checks()) + ") GROUP BY severity")
def q_check_severity(spark, sf_dir):
    """Failing checks by severity, and whether a run that must not fail is stopped by them."""
    raised = {}
    for severity in ("error", "warn"):
        try:
            Q.run_checks(raw(spark, sf_dir), [c for c in Q.source_checks() if c.severity == severity], raise_on_error=True)
            raised[severity] = False
        except AssertionError:
            raised[severity] = True
    rep = Q.run_checks(raw(spark, sf_dir), Q.source_checks(), "raw_ticks")
    return (rep.groupBy("severity").agg(F.count(F.lit(1)).alias("checks"), F.sum(F.when(F.col("failures") > 0, 1).otherwise(0)).cast("long").alias("failing"))
            .withColumn("raises", F.when(F.col("severity") == "error", F.lit(raised["error"])).otherwise(F.lit(raised["warn"]))))


@register("schema_contract", T + """SELECT 'note' AS "column", 'added' AS change, false AS breaking, count(*) AS rows FROM stg
  UNION ALL SELECT 'volume', 'removed', true, count(volume) FROM stg UNION ALL SELECT 'spread_bps', 'retyped', true, count(spread_bps) FROM stg""")
def q_schema_contract(spark, sf_dir):
    """What an update with an added, a removed and a retyped column breaks, and in how many rows."""
    s = staged(spark, sf_dir)
    return Q.schema_report(s, s.drop("volume").withColumn("spread_bps", F.col("spread_bps").cast("double")).withColumn("note", F.lit("x")))


# ------------------------------------------------------------ statistics
@register("realized_vol_two_runs", SQL["realized_vol"])
def q_realized_vol_two_runs(spark, sf_dir):
    """A first run over early ticks, a second that reads the later ones and the stored tails: equals one pass over all."""
    s, path = staged(spark, sf_dir).select("tick_id", "currency_pair", TS, "mid_price"), scratch_path(spark, "vol")
    VOL.realized_vol_run(spark, s.where(F.col(TS) < ntz_lit(INITIAL_LOAD_END)), path)
    VOL.realized_vol_run(spark, s, path)
    return VOL.realized_vol_values(spark, path).select("tick_id", "currency_pair", TS, "seq", F.round("realized_volatility", 6).alias("realized_volatility"))


@register("pair_correlation_open", T + """, x AS (SELECT date_trunc('hour', transaction_timestamp) AS b,
    CASE WHEN CAST(tick_id AS BIGINT) % 3 = 0 THEN 'NEW/' || base_currency ELSE currency_pair END AS pair, avg(CAST(mid_price AS DOUBLE)) AS m FROM stg GROUP BY ALL)
  SELECT a.pair AS pair_a, c.pair AS pair_b, round(corr(a.m, c.m), 6) AS correlation, count(*) AS n_buckets, abs(corr(a.m, c.m)) > 0.1 AS correlated
  FROM x a JOIN x c ON a.b = c.b AND a.pair < c.pair GROUP BY ALL""")
def q_pair_correlation_open(spark, sf_dir):
    """Pairs that no list knows take part."""
    new = F.when(F.col("tick_id").cast("long") % 3 == 0, F.concat(F.lit("NEW/"), "base_currency")).otherwise(F.col("currency_pair"))
    return report(SS.pair_correlation(staged(spark, sf_dir).withColumn("currency_pair", new), "1h"), rounded=("correlation",))


# ------------------------------------------------------------ counters
@register("run_counters", TR + """SELECT count(*) AS rows, CAST(count(*) FILTER (WHERE currency_pair IS NULL) AS BIGINT) AS null_pairs,
    min(transaction_timestamp) AS first_ts, max(transaction_timestamp) AS last_ts FROM raw""")
def q_run_counters(spark, sf_dir):
    """Counters that a write carries along."""
    from pyspark.sql import Observation
    seen = Observation()
    FI.with_counters(raw(spark, sf_dir), seen, TS).write.parquet(scratch_path(spark, "counted"))
    got = seen.get
    return spark.createDataFrame([(got["rows"], got["null_pairs"], got["first_ts"], got["last_ts"])],
                                 "rows long, null_pairs long, first_ts timestamp_ntz, last_ts timestamp_ntz")


@register("stream_counters", TR + """SELECT CAST(4 AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS rows,
    CAST(count(*) FILTER (WHERE currency_pair IS NULL) AS BIGINT) AS rejects FROM raw""")
def q_stream_counters(spark, sf_dir):
    """Rows and rejects of every micro-batch, as a listener wrote them: their sums are the sink's."""
    from candlewick.streaming.counters import CounterTable, counted, run_totals
    from candlewick.streaming.ingest import read_tick_stream, write_tick_stream
    src, sink, ck, path = (scratch_path(spark, n) for n in ("wire_n", "sink_n", "ckpt_n", "counters"))
    table = CounterTable(spark, path)
    spark.streams.addListener(table)
    try:
        for part in _time_ranges(spark, sf_dir):
            W.to_wire(part).write.mode("append").json(src)
            parsed = counted(W.parse_raw_ticks(read_tick_stream(spark, path=src)), F.col("currency_pair").isNull())
            write_tick_stream(parsed, sink, ck, available_now=True).awaitTermination()
            table.wait()
    finally:
        spark.streams.removeListener(table)
    return run_totals(spark.read.parquet(path))


# ------------------------------------------------------------ streams
@register("stream_resume", TR + f"SELECT {WIRE_COLS}, CAST(transaction_timestamp AS DATE) AS transaction_date FROM raw")
def q_stream_resume(spark, sf_dir):
    """The ingest stream is stopped and started again from its checkpoint, the last time with nothing new: each row once."""
    from candlewick.streaming.ingest import ingest_ticks
    src, sink, ck = (scratch_path(spark, n) for n in ("wire_r", "sink_r", "ckpt_r"))
    for part in _time_ranges(spark, sf_dir, 2):
        W.to_wire(part).write.mode("append").json(src)
        ingest_ticks(spark, sink, ck, source_path=src, available_now=True).awaitTermination()
    ingest_ticks(spark, sink, ck, source_path=src, available_now=True).awaitTermination()
    return spark.read.parquet(sink).select(*[c.strip() for c in RAW_COLS.split(",")], "transaction_date")


#: When the four deliveries of the late-row scenario end, by arrival time.
ARRIVALS = ("2024-01-08 03:20:00", "2024-01-15 12:40:00", "2024-01-23 21:10:00")


def _late_sql() -> str:
    number = " + ".join(f"CASE WHEN event_time >= TIMESTAMP '{a}' THEN 1 ELSE 0 END" for a in ARRIVALS)
    return O.with_ctes(
        *O.TICK_CTES, f"b AS (SELECT *, {number} AS batch FROM stg)",
        "m AS (SELECT x.batch, max(b.transaction_timestamp) - INTERVAL 180 MINUTE AS closed FROM (SELECT DISTINCT batch FROM b) x LEFT JOIN b ON b.batch < x.batch GROUP BY x.batch)",
        "f AS (SELECT b.*, coalesce(date_trunc('hour', transaction_timestamp) + INTERVAL 1 HOUR <= m.closed, false) AS late FROM b JOIN m USING (batch))",
        "taken AS (SELECT * FROM f WHERE NOT late)", O.candle_cte("1h", "c", "taken"),
        "l AS (SELECT currency_pair, date_trunc('hour', transaction_timestamp) AS candle_timestamp, count(*) AS n FROM f WHERE late GROUP BY 1, 2)",
    ) + """SELECT currency_pair, candle_timestamp, CAST(c.open_price AS DOUBLE) AS open_price, CAST(c.close_price AS DOUBLE) AS close_price,
      CAST(c.total_volume AS DOUBLE) AS total_volume, CAST(c.trade_count AS BIGINT) AS trade_count, CAST(coalesce(l.n, 0) AS BIGINT) AS late_ticks
    FROM c FULL OUTER JOIN l USING (currency_pair, candle_timestamp)"""


@register("stream_candles_late", _late_sql())
def q_stream_candles_late(spark, sf_dir):
    """Ticks land as they arrive, some hours late: candles of those in time, and the others counted from the side table."""
    from candlewick.streaming.ingest import read_tick_stream
    from candlewick.streaming.late import stream_candles_keeping_late
    src, root, ck = (scratch_path(spark, n) for n in ("wire_l", "late_candles", "ckpt_l"))
    r = raw(spark, sf_dir)
    for low, high in zip((None, *ARRIVALS), (*ARRIVALS, None), strict=True):
        part = r if low is None else r.where(F.col("event_time") >= ntz_lit(low))
        W.to_wire(part if high is None else part.where(F.col("event_time") < ntz_lit(high))).write.mode("append").json(src)
        ticks = ST.stage_ticks(W.parse_raw_ticks(read_tick_stream(spark, path=src)))
        stream_candles_keeping_late(ticks, "1h", root, ck, available_now=True).awaitTermination()
    late = INC.read_or_none(spark, f"{root}/late", "parquet", "batch")
    hour = F.date_trunc("hour", TS).cast("timestamp_ntz").alias("candle_timestamp")
    late = late.groupBy("currency_pair", hour).agg(F.count(F.lit(1)).alias("late_ticks"))
    c = report(INC.read_partitioned(spark, f"{root}/candles")).select(*CANDLE_KEY, "open_price", "close_price", "total_volume", "trade_count")
    return c.join(late, CANDLE_KEY, "full_outer").withColumn("late_ticks", F.coalesce("late_ticks", F.lit(0).cast("long")))


@register("stream_event_join", TE + f"""SELECT s.tick_id, s.currency_pair, s.transaction_timestamp, e.event_id, e.event_type,
    e.severity AS event_severity FROM stg s JOIN ev e ON {O.ACTIVE}""")
def q_stream_event_join(spark, sf_dir):
    """Ticks and economic events as two streams, enriched as they land: equals the batch join."""
    from candlewick.streaming.enrich import stream_event_join
    from candlewick.streaming.ingest import read_event_stream, read_tick_stream
    ticks_in, events_in, sink, ck = (scratch_path(spark, n) for n in ("wire_e", "events_e", "sink_e", "ckpt_e"))
    e = events(spark, sf_dir)
    bounds = raw(spark, sf_dir).select(F.percentile_approx(TS, 0.5)).first()[0]
    for part, own in zip(_time_ranges(spark, sf_dir, 2), (e.where(F.col("start_timestamp") <= ntz_lit(bounds)), e.where(F.col("start_timestamp") > ntz_lit(bounds))), strict=True):
        W.to_wire(part).write.mode("append").json(ticks_in)
        W.events_to_wire(own).write.mode("append").json(events_in)
        joined = stream_event_join(ST.stage_ticks(W.parse_raw_ticks(read_tick_stream(spark, path=ticks_in))), read_event_stream(spark, path=events_in))
        (joined.select("tick_id", "currency_pair", TS, "event_id", "event_type", "event_severity").writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(sink)
