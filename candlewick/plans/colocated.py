"""Candle tables that are kept in buckets of their key, so that a merge moves the update alone.

The table is partitioned by folder and bucketed and sorted by key within it.  An update is dealt to the same
buckets and anti-joined: the target is read where it lies, without an exchange.  Touched folders are
written again with dynamic partition overwrite after the merged rows are checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.plans.incremental import KEYS, require_same_schema, touched_partitions
from candlewick.session import checkpoint_dir


def create_bucketed(df: DataFrame, table: str, keys=KEYS, partition: str = "partition", buckets: int = 8) -> None:
    """Build ``table`` in the session's catalog from ``df``: one file for each folder and bucket."""
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").partitionBy(partition)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(rows["Num Buckets"])


def merged_rows(spark: SparkSession, table: str, updates: DataFrame, touched, keys=KEYS, partition: str = "partition") -> DataFrame:
    """The touched folders with the update's rows in place of those of equal key.  The update is dealt to the table's buckets
    (the hint keeps it from being broadcast, whatever its size); the target stays where it is."""
    keys = list(keys)
    target = spark.table(table).where(F.col(partition).isin(list(touched)))
    dealt = updates.repartition(bucket_count(spark, table), *keys)
    kept = target.join(dealt.select(*keys).hint("merge"), keys, "left_anti").select(*target.columns)
    return kept.unionByName(dealt.select(*target.columns))


def upsert_bucketed(spark: SparkSession, table: str, updates: DataFrame, keys=KEYS, partition: str = "partition") -> None:
    """Merge ``updates`` into the bucketed ``table``; columns that differ and repeated or null keys are refused."""
    checkpoint_dir(spark)
    require_same_schema(spark.table(table), updates)
    updates = updates.checkpoint(eager=True)
    touched = touched_partitions(updates, keys, partition)
    if not touched:
        return
    merged = merged_rows(spark, table, updates, touched, keys, partition).checkpoint(eager=True)  # never reads what it replaces
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        merged.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
