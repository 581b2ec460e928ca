"""Run counters of streaming queries: rows, rejects and rate of every micro-batch, written to a table by a listener."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

COUNTERS = ("run_id string, batch long, at string, input_rows long, rows long, rejects long, "
            "rows_per_second double")
METRIC = "run_counters"


def counted(df: DataFrame, rejected: Column) -> DataFrame:
    """The stream with its rows and rejects observed as it runs; no extra pass."""
    return df.observe(METRIC, F.count(F.lit(1)).alias("rows"), F.sum(F.when(rejected, 1).otherwise(0)).alias("rejects"))


class CounterTable(StreamingQueryListener):
    """Appends a row of counters to ``path`` for each micro-batch of a ``counted`` stream.

    ``wait`` returns when the progress of all finished runs is in the table: the bus hands on a run's end after its progress."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended = spark, path, threading.Semaphore(0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(METRIC)
        if seen is None:
            return
        row = (str(p.runId), int(p.batchId), p.timestamp, int(p.numInputRows), int(seen["rows"] or 0), int(seen["rejects"] or 0),
               float(p.processedRowsPerSecond))
        self.spark.createDataFrame([row], COUNTERS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        self.ended.release()

    def wait(self, runs: int = 1, seconds: float = 60) -> None:
        for _ in range(runs):
            if not self.ended.acquire(timeout=seconds):
                raise TimeoutError("a streaming run's end was not reported")


def run_totals(table: DataFrame) -> DataFrame:
    """(batches, rows, rejects) of a counter table; a batch reported twice counts once."""
    each = table.groupBy("run_id", "batch").agg(F.max("rows").alias("rows"), F.max("rejects").alias("rejects"))
    return each.agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"), F.sum("rejects").alias("rejects"))
