"""Skew evidence from Spark's event log.

Derives a skewed tick view from the given table — every third tick moved to
one pair at one single instant — and runs ordered-sequence operators three
ways: a naive per-pair window, time chunks, and balanced rank chunks.  For
each run it reads the event log (written to a fresh scratch folder) and
reports the most shuffle records any single task read, as a share of rows.

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_detail(log_dir: str, job_group: str) -> dict:
    stages, names, per = set(), {}, defaultdict(lambda: [0, 0, 0])
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart" and (ev.get("Properties") or {}).get("spark.jobGroup.id") == job_group:
                    stages.update(ev.get("Stage IDs", []))
                    for si in ev.get("Stage Infos", []):
                        names[si["Stage ID"]] = si.get("Stage Name", "")[:40]
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    r = int(m.get("Total Records Read", 0))
                    d = per[ev["Stage ID"]]
                    d[0] = max(d[0], r)
                    d[1] += r
                    d[2] += 1
    return {k: (names.get(k, ""), *v) for k, v in sorted(per.items())}


def max_task_records(log_dir: str, job_group: str) -> tuple[int, int]:
    """(max shuffle records read by one task, tasks) over the stages of the
    jobs tagged with ``job_group``."""
    stages, best, tasks = set(), 0, 0
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        stages.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    best = max(best, int(m.get("Total Records Read", 0)))
                    tasks += 1
    return best, tasks


def main():
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from candlewick.operators import stats as SS
    from candlewick.functions.columns import bucket
    from candlewick.operators.candles import add_row_numbers, ohlc_candles
    from candlewick.operators.events import event_impact
    from candlewick.operators.staging import dedup_ticks
    from candlewick.sources.fixtures import economic_events
    from candlewick.operators.staging import stage_ticks
    from candlewick.session import get_spark
    from candlewick.sources.fixtures import raw_ticks

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    # emulate data >> partition size (as on a cluster): 64 fixed ranges and
    # no coalescing, so a task's shuffle input is one partition's work; at
    # this size AQE would otherwise (correctly) merge everything into one
    spark = get_spark("local[8]", 64, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                                 "spark.eventLog.compress": "false",
                                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    s = stage_ticks(raw_ticks(spark, sf_dir))
    hot = F.col("tick_id").cast("long") % 3 == 0
    skewed = (s.withColumn("currency_pair", F.when(hot, F.lit("ECR/MRT")).otherwise(F.col("currency_pair")))
              .withColumn("base_currency", F.when(hot, F.lit("ECR")).otherwise(F.col("base_currency")))
              .withColumn("quote_currency", F.when(hot, F.lit("MRT")).otherwise(F.col("quote_currency")))
              .withColumn("transaction_timestamp",
                          F.when(hot, F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
                          .otherwise(F.col("transaction_timestamp"))))
    total = skewed.count()
    w = Window.partitionBy("currency_pair").orderBy("transaction_timestamp", "tick_id")
    runs = {
        "naive per-pair window": skewed.withColumn("prev", F.lag("mid_price").over(w)),
        "log_returns, 1h chunks": SS.log_returns(skewed, chunk="1h"),
        "log_returns, balanced": SS.log_returns(skewed, n_chunks=64),
        "realized_vol, balanced": SS.realized_vol(skewed, block_rows=4096, n_chunks=64),
        "tick_gaps, balanced": SS.tick_gaps(skewed, n_chunks=64),
        "add_row_numbers, window": add_row_numbers(skewed.withColumn("b", bucket("transaction_timestamp", "1h")),
                                                   ["currency_pair", "b"], ["transaction_timestamp", "tick_id"],
                                                   skew_safe=False),
        "add_row_numbers, skew-safe": add_row_numbers(skewed.withColumn("b", bucket("transaction_timestamp", "1h")),
                                                      ["currency_pair", "b"], ["transaction_timestamp", "tick_id"]),
        "ohlc_1min (partial agg)": ohlc_candles(skewed, "1min"),
        "dedup by business key": dedup_ticks(skewed, keys=("currency_pair", "transaction_timestamp")),
        "event_impact (broadcast)": event_impact(skewed, economic_events(spark, sf_dir)),
    }
    for name, df in runs.items():
        sc.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    print(f"rows={total}, hot group = {total // 3} rows at one pair and one instant")
    for name in runs:
        best, tasks = max_task_records(log_dir, name)
        print(f"{name:26s} max shuffle records in one task = {best:7d} ({best / total:6.1%} of rows), tasks={tasks}")
        if os.environ.get("SKEW_DETAIL"):
            for sid, (sname, mx, tot, n) in stage_detail(log_dir, name).items():
                print(f"    stage {sid:3d} {sname:40s} tasks={n:4d} max={mx:7d} total={tot:7d}")


if __name__ == "__main__":
    main()
