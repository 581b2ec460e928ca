"""Deterministic tick and event views over the driver's ``events`` table.

The source system ships no data; its tests read generator output.  These views
derive a deliberately dirty tick stream and an economic-event table from the
given ``events`` parquet so that every query's work grows with that table.
The derivation rules are the test-input contract (FIXTURES.md §3, §4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pair_from_user(user_id):
    m = user_id % 6
    return (F.when(m == 0, "ECR/MRT").when(m == 1, "ECR/LCR").when(m == 2, "ECR/AMC")
            .when(m == 3, "MRT/LCR").when(m == 4, "MRT/AMC").otherwise("LCR/AMC"))


def raw_ticks_from_events(events: DataFrame) -> DataFrame:
    """Raw tick rows (stream-sink schema) derived from the events table."""
    eid, uid, value = F.col("event_id"), F.col("user_id"), F.col("value")
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))   # no-op when read as NTZ
    s = F.lit(3) + eid % 28
    crossed = eid % 97 == 0
    lo = value * (F.lit(1.0) - s / F.lit(20000.0))
    hi = value * (F.lit(1.0) + s / F.lit(20000.0))
    return events.select(
        eid.cast("string").alias("tick_id"),
        F.col("ts").alias("transaction_timestamp"),
        F.when(eid % 101 == 0, F.lit(None).cast("string")).otherwise(_pair_from_user(uid)).alias("currency_pair"),
        F.when(crossed, hi).otherwise(lo).alias("bid_price"),
        F.when(crossed, lo).otherwise(hi).alias("ask_price"),
        value.alias("mid_price"),
        s.cast("double").alias("spread_bps"),
        (value * (F.lit(1.0) + (eid % 13 - 6) * F.lit(0.00005))).alias("trade_price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.when(eid % 89 == 7, "Asteroid_Market").when(eid % 4 == 0, "Earth_FX_Hub").when(eid % 4 == 1, "Mars_Central_Exchange")
         .when(eid % 4 == 2, "Lunar_Trading_Post").otherwise("Asteroid_Belt_Hub").alias("exchange_location"),
        F.when(F.col("event_type") == "click", "institutional").when(F.col("event_type") == "view", "retail")
         .when(F.col("event_type") == "purchase", "mining_corp").when(F.col("event_type") == "signup", "government")
         .otherwise("unknown").alias("trader_type"),
        (F.col("ts") + F.make_dt_interval(hours=F.when(eid % 13 == 5, 6).otherwise(0), secs=(eid % 7).cast("decimal(18,6)"))).alias("event_time"),
    )


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_ticks_from_events(read_table(spark, sf_dir, "events"))


def economic_events_from_events(events: DataFrame) -> DataFrame:
    """Economic events (interval table) derived from the events table."""
    eid, uid = F.col("event_id"), F.col("user_id")
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))   # no-op when read as NTZ
    m = uid % 6
    etype = (F.when(m == 0, "SOLAR_STORM").when(m == 1, "TRADE_TARIFF").when(m == 2, "OXYGEN_CRISIS")
             .when(m == 3, "MINING_STRIKE").when(m == 4, "POLICY_CHANGE").otherwise("SUPPLY_SHOCK"))
    affected = (F.when(m == 0, F.array(F.lit("MRT"), F.lit("AMC")))
                .when(m == 1, F.array(F.lit("ECR"), F.lit("MRT"), F.lit("LCR")))
                .when(m == 2, F.array(F.lit("MRT")))
                .when(m == 3, F.array(F.lit("AMC")))
                .when(m == 4, F.array(F.lit("ECR"), F.lit("LCR")))
                .otherwise(F.array(F.lit("MRT"), F.lit("AMC"))))
    minutes = F.lit(30) + eid % 690
    return (events.where(F.col("event_type") == "error")
            .select(F.concat(F.lit("EV"), eid.cast("string")).alias("event_id"),
                    etype.alias("event_type"),
                    F.col("ts").alias("event_timestamp"),
                    F.col("ts").alias("start_timestamp"),
                    (F.col("ts") + F.make_dt_interval(mins=minutes.cast("int"))).alias("end_timestamp"),
                    (F.lit(1) + eid % 5).alias("severity"),
                    affected.alias("affected_currencies"),
                    (F.lit(1.0) + (eid % 5) * F.lit(0.25)).alias("spread_multiplier"),
                    (F.lit(1.0) + (eid % 4) * F.lit(0.5)).alias("volatility_multiplier"),
                    (F.lit(0.5) + (eid % 6) * F.lit(0.25)).alias("volume_multiplier")))


def economic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return economic_events_from_events(read_table(spark, sf_dir, "events"))
