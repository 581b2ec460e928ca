"""File sources and sinks: recursive Parquet scans, CSV seeds with declared
types, partitioned appends, table materialisation (Parquet/ORC, sorted within
partitions), partition / file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.functions.columns import PARTITION_FOR_INTERVAL, partition_value


def read_tick_files(spark: SparkSession, path: str, schema: StructType | None = None,
                    fmt: str = "parquet") -> DataFrame:
    """Every file under ``path`` (any nesting, e.g. ``YYYY-MM-DD/HH.parquet``).
    The layout is not ``key=value``, so there is no partition inference:
    filter on the timestamp column and let the scan prune row groups."""
    r = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def load_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV seed with header and declared column types; malformed rows fail."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def write_ticks(df: DataFrame, path: str, ts: str = "transaction_timestamp", fmt: str = "parquet",
                partitions: int | None = None) -> None:
    """Append ticks partitioned by date / hour (no read-modify-write).

    One shuffle by folder, without a sampling pass: adaptive execution joins
    small hours in a task and splits an hour that is too large for one.  With
    ``partitions``, rows are range-partitioned into that many tasks instead."""
    out = df.withColumn("date", F.to_date(ts)).withColumn("hour", F.hour(ts))
    out = out.repartitionByRange(partitions, ts) if partitions else out.hint("rebalance", "date", "hour")
    (out.write.mode("append").partitionBy("date", "hour").format(fmt).save(path))


def partition_col(interval: str) -> str:
    """Partition transform used for a candle grain: hour/day/month/year."""
    try:
        return PARTITION_FOR_INTERVAL[interval]
    except KeyError:
        raise ValueError(f"no partition transform for {interval!r}") from None


def materialize(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None,
                sort_by=None, mode: str = "overwrite") -> None:
    """Full rebuild of a table.  With ``partition_by``, rows are range-
    partitioned on (partition, sort columns): each task writes a contiguous
    slice of few partitions and a hot partition is split across tasks by the
    range sampler (hash partitioning would give it one task).  Rows are
    sorted within partitions on ``sort_by`` (tight row-group min/max)."""
    out = df
    if partition_by:
        parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        out = out.repartitionByRange(*parts, *(sort_by or []))
        if sort_by:
            out = out.sortWithinPartitions(*parts, *sort_by)
        w = out.write.mode(mode).format(fmt).partitionBy(*parts)
    else:
        if sort_by:
            out = out.sortWithinPartitions(*sort_by)
        w = out.write.mode(mode).format(fmt)
    w.save(path)


def table_partitions(df: DataFrame, partition_cols) -> DataFrame:
    """Partition listing: rows per partition value (``$partitions``)."""
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("record_count"))


def table_files(df: DataFrame) -> DataFrame:
    """File listing: path, size and rows per data file (``$files``)."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
            .groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("record_count")))


def with_counters(df: DataFrame, observation, ts: str | None = None) -> DataFrame:
    """Attach run counters (rows, NULL pairs, min/max time) to an action via
    ``DataFrame.observe`` — collected as a side effect, no extra scan."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "currency_pair" in df.columns:
        metrics.append(F.sum(F.when(F.col("currency_pair").isNull(), 1).otherwise(0)).alias("null_pairs"))
    if ts:
        metrics += [F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")]
    return df.observe(observation, *metrics)


def compact(spark: SparkSession, path: str, partition: str, partitions, rows_per_file: int = 5_000_000,
            fmt: str = "parquet", sort_by=None) -> None:
    """Rewrite the listed partitions of a table into fewer, larger files
    (e.g. after many small stream rolls): read them, range-partition to about
    ``rows_per_file`` rows per task, checkpoint (so the rewrite never reads
    the files it replaces), then dynamic partition overwrite."""
    from candlewick.plans.incremental import read_partitioned
    from candlewick.session import checkpoint_dir
    part = read_partitioned(spark, path, partition, fmt).where(F.col(partition).isin(list(partitions)))
    n = max(1, -(-part.count() // rows_per_file))
    checkpoint_dir(spark)
    frozen = part.checkpoint(eager=True)
    out = frozen.repartitionByRange(n, partition, *(sort_by or []))
    if sort_by:
        out = out.sortWithinPartitions(partition, *sort_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
     .partitionBy(partition).save(path))


def partition_by_key(df: DataFrame, key: str = "currency_pair", n: int | None = None) -> DataFrame:
    """Hash-partition by a key (the topic layout: one pair per partition)."""
    return df.repartition(n, key) if n else df.repartition(key)
