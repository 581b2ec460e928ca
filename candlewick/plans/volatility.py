"""Rolling realised volatility carried from run to run.

A run reads the ticks after the last stored one and each pair's tail, the last prices of the run before, and
never the history.  Values lie in a folder of their run; the new tail is written last.  A run that is cut off
left no tail, so the next one has its number and replaces what it had written.

Ticks at or before the stored mark that come later are no part of any run; ``late_ticks`` reports them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.constants import ANNUALIZATION_PERIODS, REALIZED_VOL_WINDOW
from candlewick.functions.columns import ntz_lit, since_predicate
from candlewick.operators.events import with_pair_reference
from candlewick.operators.stats import TS
from candlewick.operators.windows import chunked_sequence, rolling_rows
from candlewick.plans.incremental import read_or_none

_COLS = ("currency_pair", TS, "tick_id")


def realized_vol_run(spark: SparkSession, ticks: DataFrame, path: str, n: int = REALIZED_VOL_WINDOW, periods: int = ANNUALIZATION_PERIODS,
                     price: str = "mid_price", block_rows: int = 100_000, n_chunks: int | None = None) -> int:
    """Append the volatility of the new ticks under ``path``; the run's number (that of the last one, if no tick is new).  A pair has as many tail rows as the window is long."""
    tails = read_or_none(spark, f"{path}/tails", "parquet", "run")
    last = tails and tails.agg(F.max(F.col("run").cast("int"))).first()[0]
    run = (last or 0) + 1
    new, fresh = ticks, F.lit(True)
    if last:
        tail = tails.where(F.col("run").cast("int") == last).drop("run")
        mark = tail.agg(F.max(TS)).first()[0]
        new = ticks.where(since_predicate(ticks.columns, TS, mark) & (F.col(TS) > ntz_lit(mark)))
    if new.isEmpty():
        return last or 0
    rows = new.select(*_COLS, price, F.lit(None).cast("long").alias("_seq"))
    if last:
        rows = rows.unionByName(tail.withColumnRenamed("seq", "_seq"))
    seq = chunked_sequence(rows, ["currency_pair"], [TS, "tick_id"], [price], n_chunks=n_chunks)
    if last:
        # A pair's positions go on from its tail: one row per pair.
        base = tail.groupBy("currency_pair").agg((F.min("seq") - 1).alias("_base")).withColumnRenamed("currency_pair", "_pair")
        seq = seq.join(base, F.col("currency_pair").eqNullSafe(F.col("_pair")), "left").withColumn("seq", F.col("seq") + F.coalesce("_base", F.lit(0)))
        seq = seq.drop("_pair", "_base")
        fresh = F.col("_seq").isNull()
    seq = seq.withColumn("log_return", F.log(F.col(price).cast("double")) - F.log(F.col(f"prev_{price}").cast("double")))
    rolled = rolling_rows(seq, ["currency_pair"], "seq", n - 1, {"_std": F.stddev_pop("log_return")}, block_rows).where(fresh)
    rolled = with_pair_reference(rolled, ["volatility"])
    value = F.when(F.col("seq") < 2, F.col("pair_volatility")).otherwise(F.col("_std") * F.lit(math.sqrt(periods)))
    out = rolled.select(*_COLS, price, "seq", value.alias("realized_volatility"), F.lit(str(run)).alias("run"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{path}/values")
    written = read_or_none(spark, f"{path}/values", "parquet", "run")
    own = written.where(F.col("run") == str(run)).select(*_COLS, price, "seq")
    known = own.unionByName(tail.select(own.columns)) if last else own
    ends = known.groupBy("currency_pair").agg(F.max("seq").alias("_end")).withColumnRenamed("currency_pair", "_pair")
    kept = known.join(ends, F.col("currency_pair").eqNullSafe(F.col("_pair"))).where(F.col("seq") > F.col("_end") - (n - 1))
    (kept.select(own.columns).withColumn("run", F.lit(str(run))).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{path}/tails"))
    return run


def realized_vol_values(spark: SparkSession, path: str) -> DataFrame:
    """All values written under ``path``."""
    return read_or_none(spark, f"{path}/values", "parquet", "run").drop("run")
