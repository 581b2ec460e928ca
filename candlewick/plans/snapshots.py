"""Stored type-2 snapshots, kept up by runs over a current table.

A run compares the current rows with the open versions of a stored table: a new key opens a
version, a changed key closes its open version and opens another, a key that is gone closes its
version.  Versions live in folders by partition, and a key always falls into the partition that
its row names, so a run reads and rewrites the folders it is given and, of these, only those with a
change.  A repeated run finds no change and writes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.columns import ntz_lit
from candlewick.plans.incremental import read_or_none, require_keys, require_same_schema, write_folders
from candlewick.session import checkpoint_dir

VERSION_COLS = ("valid_from", "valid_to")


def _differs(columns, left: str, right: str) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns], F.lit(False))


def snapshot_changes(open_versions: DataFrame, current: DataFrame, keys, partition: str = "partition") -> DataFrame:
    """(action, old, new): ``open``, ``change`` or ``close`` for every key that is new, differs or is gone."""
    keys = [partition, *keys]
    pack = lambda df, name: df.select(*keys, F.struct(*[F.col(c) for c in current.columns]).alias(name))
    both = pack(open_versions, "old").join(pack(current, "new"), keys, "full_outer")
    action = (F.when(F.col("old").isNull(), "open").when(F.col("new").isNull(), "close")
              .when(_differs([c for c in current.columns if c not in keys], "old", "new"), "change"))
    return both.select(*keys, action.alias("action"), "new").where("action is not null")


def snapshot_run(spark: SparkSession, path: str, current: DataFrame, keys, run_at, partition: str = "partition",
                 partitions=None, fmt: str = "parquet") -> dict[str, int]:
    """Bring the snapshot table at ``path`` up to ``current`` as of ``run_at``; counts of opened, changed and closed keys.

    ``partitions`` restricts a run to folders known to have changed: ``current`` then holds whole partitions of that list, and
    keys of other folders are neither read nor closed.  Repeated or null keys and columns that differ from the table's are refused."""
    keys = list(keys)
    if partitions is not None:
        current = current.where(F.col(partition).isin(list(partitions)))
    require_keys(current, keys)
    now = ntz_lit(run_at)
    stored = read_or_none(spark, path, fmt, partition)
    if stored is None:
        rows = current.withColumn("valid_from", now).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
        write_folders(rows, path, keys, partition, fmt)
        return {"opened": read_or_none(spark, path, fmt, partition).count(), "changed": 0, "closed": 0}
    require_same_schema(stored.drop(*VERSION_COLS), current)
    if partitions is not None:
        stored = stored.where(F.col(partition).isin(list(partitions)))
    checkpoint_dir(spark)
    current = current.select([c for c in stored.columns if c not in VERSION_COLS])
    changes = snapshot_changes(stored.where("valid_to is null"), current, keys, partition).checkpoint(eager=True)
    told = {(r[0], r[1]): r[2] for r in changes.groupBy("action", partition).agg(F.count(F.lit(1))).collect()}  # folders, not rows
    counts = {name: sum(n for (a, _), n in told.items() if a == action)
              for name, action in (("opened", "open"), ("changed", "change"), ("closed", "close"))}
    if not told:
        return counts
    touched = sorted({p for _, p in told})
    old = stored.where(F.col(partition).isin(touched))
    ended = changes.where("action <> 'open'").select(partition, *keys, F.lit(True).alias("_ends"))
    old = old.join(ended, [partition, *keys], "left")
    old = old.withColumn("valid_to", F.when(F.col("valid_to").isNull() & F.col("_ends"), now).otherwise(F.col("valid_to"))).select(*stored.columns)
    new = changes.where("action <> 'close'").select("new.*").withColumn("valid_from", now).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    write_folders(old.unionByName(new).checkpoint(eager=True), path, [*keys, "valid_from"], partition, fmt)  # never reads what it replaces
    return counts
