"""Incremental candle maintenance.

* high-water mark of the target read once as a literal (one-row action), so
  the tick filter is a plain ``ts >= literal`` that reaches the Parquet scan;
* the cutoff is floored to the candle grid, so a lookback that is not a
  multiple of the grain never rebuilds a partial candle;
* an existing-but-empty target means a full build, not "nothing forever";
* upsert = anti join on the unique key + union, limited to the partitions
  the update touches, written with dynamic partition overwrite after the
  merged result is checkpointed to the shared checkpoint folder (survives
  executor loss, and never reads the files it replaces during the write).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from candlewick.constants import LOOKBACK_MINUTES
from candlewick.functions.columns import bucket, grid_floor_literal, ntz_lit, partition_value, since_predicate
from candlewick.operators.candles import ohlc_candles
from candlewick.operators.quality import schema_changes
from candlewick.session import checkpoint_dir
from candlewick.sources.files import partition_col

KEYS = ("currency_pair", "candle_timestamp")


def high_water_mark(target: DataFrame | None, col: str = "candle_timestamp"):
    if target is None:
        return None
    return target.agg(F.max(col)).first()[0]


def incremental_cutoff(hwm, interval: str, lookback_minutes: int | None = None):
    """Grid-floored ``hwm - lookback``; None (full build) when there is no mark."""
    if hwm is None:
        return None
    lb = LOOKBACK_MINUTES.get(interval, 0) if lookback_minutes is None else lookback_minutes
    return grid_floor_literal(hwm - _dt.timedelta(minutes=lb), interval)


def incremental_slice(ticks: DataFrame, target: DataFrame | None, interval: str,
                      lookback_minutes: int | None = None, ts: str = "transaction_timestamp") -> DataFrame:
    """Ticks that the next incremental run must (re)aggregate."""
    cutoff = incremental_cutoff(high_water_mark(target), interval, lookback_minutes)
    if cutoff is None:
        return ticks
    return ticks.where(since_predicate(ticks.columns, ts, cutoff))


def late_ticks(ticks: DataFrame, cutoff, arrived_after, ts: str = "transaction_timestamp",
               arrival: str = "event_time", interval: str = "1min") -> DataFrame:
    """Ticks that arrived after ``arrived_after`` but belong before ``cutoff``:
    an incremental run will never aggregate them.  Counted per candle."""
    late = ticks.where((F.col(ts) < ntz_lit(cutoff)) &
                       (F.col(arrival) > ntz_lit(arrived_after)))
    return (late.groupBy("currency_pair", bucket(ts, interval).alias("candle_timestamp"))
            .agg(F.count(F.lit(1)).alias("late_ticks"), F.max(arrival).alias("last_arrival")))


def upsert(target: DataFrame, updates: DataFrame, keys=KEYS) -> DataFrame:
    """Rows of ``updates`` replace target rows with the same key; other
    target rows are kept (MERGE ... update all / insert all)."""
    keys = list(keys)
    kept = target.join(updates.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(updates)


def merge_into(updates: DataFrame, table: str, keys=KEYS) -> None:
    """Upsert into a catalog table whose format supports MERGE (Delta,
    Iceberg, ...): update all columns of matching keys, insert the rest.
    Plain Parquet tables do not support MERGE; use ``upsert_path`` there."""
    keys = list(keys)
    cond = None
    for k in keys:
        c = F.col(f"{table}.{k}") == F.col(f"source.{k}")
        cond = c if cond is None else cond & c
    (updates.alias("source").mergeInto(table, cond)
     .whenMatched().updateAll().whenNotMatched().insertAll().merge())


def read_partitioned(spark: SparkSession, path: str, partition: str = "partition", fmt: str = "parquet") -> DataFrame:
    """Read a table partitioned by a string transform value; the partition
    column is declared as string (inference would turn '2024-01-01' into a
    date and '2024' into an integer)."""
    inferred = spark.read.format(fmt).load(path)
    fields = [StructField(f.name, StringType(), True) if f.name == partition else f for f in inferred.schema.fields]
    return spark.read.format(fmt).schema(StructType(fields)).load(path)


def read_or_none(spark: SparkSession, path: str, fmt: str, partition: str = "partition"):
    """The table at ``path`` with its own schema; None only when the path is proven missing.

    Any other error (storage, permissions, unreadable files) is raised: taking it
    for "no table" would replace the history by the update."""
    try:
        return read_partitioned(spark, path, partition, fmt)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def require_same_schema(target: DataFrame, updates: DataFrame) -> None:
    """Fail on columns that an update lacks, adds or types differently."""
    change = schema_changes(updates.schema, target.schema)
    if any(change.values()):
        raise AssertionError(f"schema change against the table: {change}")


def require_keys(df: DataFrame, keys) -> None:
    """Fail on rows that share a key or lack a part of it: a merge could not tell which of them wins, or would never find them again."""
    keys = list(keys)
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | lacking).limit(1).collect()
    if bad:
        raise AssertionError(f"repeated or null key: {bad[0].asDict()}")


def touched_partitions(updates: DataFrame, keys, partition: str = "partition") -> list:
    """The folders that ``updates`` falls into, from one aggregation that also checks its keys (see ``require_keys``)."""
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = updates.groupBy(partition, *keys).agg(F.count(F.lit(1)).alias("n"))
    told = per_key.groupBy(partition).agg(F.max((F.col("n") > 1) | lacking).alias("bad")).collect()  # folders, not rows
    if any(r["bad"] for r in told):
        require_keys(updates, keys)
    return [r[partition] for r in told]


def write_folders(rows: DataFrame, path: str, keys, partition: str, fmt: str) -> None:
    """Rows to their folders, sorted by key: one shuffle by folder without a sampling pass; adaptive execution joins small
    folders in a task and splits one that is too large for it."""
    (rows.hint("rebalance", partition).sortWithinPartitions(partition, *keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy(partition).save(path))


def append_new(spark: SparkSession, path: str, batch: DataFrame, batch_id: str, key: str = "tick_id", ts: str = "transaction_timestamp",
               days_back: int = 1, fmt: str = "parquet") -> None:
    """Insert the rows of a delivery whose id is not stored yet; every id is stored once.

    Of rows that share an id within the delivery the first by time stays.  Stored ids are looked up in the date folders of the
    delivery's rows and of ``days_back`` days on either side, so a redelivery that far off is still found and no other folder is read.
    Files go to (date, batch) folders that only this batch writes and that its own lookup leaves out: a delivery that was
    cut off is delivered again under the same id and replaces what it had written."""
    checkpoint_dir(spark)
    rows = batch.withColumn("date", F.to_date(ts)).withColumn("batch", F.lit(str(batch_id)))
    first = rows.groupBy(key).agg(F.min(F.struct(ts, *[F.col(c) for c in rows.columns if c not in (ts, key)])).alias("_r"))
    rows = first.select(key, "_r.*").select(*rows.columns).checkpoint(eager=True)
    dates = [r[0] for r in rows.select("date").distinct().collect()]  # folders, not rows
    if not dates:
        return
    span = [d + _dt.timedelta(days=k) for d in dates if d is not None for k in range(-days_back, days_back + 1)]
    stored = read_or_none(spark, path, fmt, "batch")
    if stored is not None:
        near = stored.where(F.col("date").isin(sorted(set(span))) & (F.col("batch") != str(batch_id)))
        rows = rows.join(near.select(key), key, "left_anti").select(*rows.columns)
    (rows.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy("date", "batch").save(path))


def upsert_path(spark: SparkSession, path: str, updates: DataFrame, keys=KEYS,
                partition: str = "partition", fmt: str = "parquet") -> None:
    """Upsert into a partitioned table on disk, rewriting only the touched partitions.

    The update must have exactly the table's columns and types, and each of its keys
    whole and once; otherwise it fails and the table is left as it is.  Only a missing path is built anew."""
    keys = list(keys)
    target = read_or_none(spark, path, fmt, partition)
    checkpoint_dir(spark)  # make sure a shared checkpoint folder is set
    if target is None:
        require_keys(updates, keys)
        write_folders(updates, path, keys, partition, fmt)
        return
    require_same_schema(target, updates)
    updates = updates.checkpoint(eager=True)  # evaluated once: key check, partitions, anti join and union all read it
    touched = touched_partitions(updates, keys, partition)
    old = target.where(F.col(partition).isin(touched))
    merged = upsert(old, updates.select(*target.columns), keys)
    write_folders(merged.checkpoint(eager=True), path, keys, partition, fmt)  # never reads the files it replaces


def _rebuild(candles: DataFrame, path: str, fmt: str) -> None:
    """A candle table anew: whatever lies at ``path`` goes."""
    (candles.hint("rebalance", "partition").sortWithinPartitions("partition", *KEYS)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt).partitionBy("partition").save(path))


def build_candles(spark: SparkSession, ticks: DataFrame, path: str, interval: str,
                  full_refresh: bool = False, lookback_minutes: int | None = None,
                  fmt: str = "parquet") -> None:
    """Full or incremental build of one candle table at ``path``."""
    part = partition_col(interval)
    target = None if full_refresh else read_or_none(spark, path, fmt)
    if target is not None:
        built = ohlc_candles(ticks, interval).withColumn("partition", partition_value("candle_timestamp", part))
        require_same_schema(target, built)
    src = ticks if target is None else incremental_slice(ticks, target, interval, lookback_minutes)
    candles = ohlc_candles(src, interval).withColumn("partition", partition_value("candle_timestamp", part))
    if target is None:
        _rebuild(candles, path, fmt)
    else:
        upsert_path(spark, path, candles, KEYS, "partition", fmt)


def build_all_candles(spark: SparkSession, ticks: DataFrame, root: str,
                      intervals=("1min", "5min", "1h", "1d"), full_refresh: bool = False,
                      fmt: str = "parquet") -> dict[str, str]:
    """Maintain every candle table under ``root/ohlc_<interval>`` from ONE
    slice of the ticks and ONE aggregation: the slice starts at the earliest
    per-table cutoff (the coarsest lookback, which lies on every finer grid),
    the 1-minute state is built once and rolled up, and each table gets an
    upsert of its recomputed candles from its own cutoff on (the same
    candles a per-table incremental run would write)."""
    from candlewick.operators.candles import multi_grain_candles
    paths = {iv: f"{root.rstrip('/')}/ohlc_{iv}" for iv in intervals}
    targets = {iv: None if full_refresh else read_or_none(spark, p, fmt) for iv, p in paths.items()}
    cutoffs = {iv: incremental_cutoff(high_water_mark(t), iv) if t is not None else None for iv, t in targets.items()}
    full = any(c is None for c in cutoffs.values())
    src = ticks if full else ticks.where(since_predicate(ticks.columns, "transaction_timestamp", min(cutoffs.values())))
    grains = multi_grain_candles(src, intervals)
    for iv, candles in grains.items():
        part = partition_col(iv)
        if cutoffs[iv] is not None:
            # each table keeps its own lookback: only candles from its cutoff are rewritten
            candles = candles.where(F.col("candle_timestamp") >= ntz_lit(cutoffs[iv]))
        candles = candles.withColumn("partition", partition_value("candle_timestamp", part))
        if targets[iv] is None:
            _rebuild(candles, paths[iv], fmt)
        else:
            upsert_path(spark, paths[iv], candles, KEYS, "partition", fmt)
    return paths


def candles_as_of(history: DataFrame, as_of, keys=KEYS, version: str = "calculated_at") -> DataFrame:
    """Latest version of each key with ``version <= as_of`` (time travel over
    an append-only history).  Aggregation with max over a struct led by the
    version column: combinable map-side, no window over large groups."""
    keys = list(keys)
    h = history.where(F.col(version) <= ntz_lit(as_of))
    rest = [c for c in history.columns if c not in keys and c != version]
    latest = h.groupBy(*keys).agg(F.max(F.struct(F.col(version).alias(version), *[F.col(c) for c in rest])).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in [version] + rest]).select(*history.columns)


def snapshots(history: DataFrame, version: str = "calculated_at", keys=KEYS) -> DataFrame:
    """Version listing of an append-only history (the ``$snapshots`` view):
    one row per version with rows written and distinct keys touched."""
    keys = list(keys)
    per_key = history.groupBy(version, *keys).agg(F.count(F.lit(1)).alias("_n"))
    return (per_key.groupBy(version).agg(F.sum("_n").alias("rows_written"),
                                         F.count(F.lit(1)).alias("keys_touched"))
            .withColumn("is_latest", F.col(version) == F.max(version).over(Window.partitionBy())))


def scd2(history: DataFrame, keys, updated_at: str, tie=()) -> DataFrame:
    """Type-2 history: valid_from = updated_at, valid_to = next version's
    updated_at (NULL for the current row), is_current.

    One ``lead`` over the key: a key has as many rows as it has versions."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    by_version = Window.partitionBy(*keys).orderBy(updated_at, *tie)
    return (history.withColumn("valid_from", F.col(updated_at))
            .withColumn("valid_to", F.lead(updated_at).over(by_version))
            .withColumn("is_current", F.col("valid_to").isNull())
            .select(*history.columns, "valid_from", "valid_to", "is_current"))


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
