import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import Observation
from pyspark.sql import functions as F

from candlewick.constants import PAIR_SEED_ROWS
from candlewick.operators.events import calendar_reference, pairs_reference
from candlewick.schemas import CURRENCY_PAIRS_SEED
from candlewick.session import scratch_path
from candlewick.sources import files as FI
from candlewick.sources.fixtures import economic_events, raw_ticks
from candlewick.sources.wire import to_kafka_records
from candlewick.streaming.ingest import read_event_stream


def test_seed_csv_roundtrip_with_declared_types(spark, tmp_path):
    p = tmp_path / "currency_pairs.csv"
    header = ",".join(f.name for f in CURRENCY_PAIRS_SEED.fields)
    p.write_text(header + "\n" + "\n".join(",".join(str(x).lower() if isinstance(x, bool) else str(x) for x in r)
                                           for r in PAIR_SEED_ROWS) + "\n")
    seed = FI.load_seed(spark, str(p), CURRENCY_PAIRS_SEED)
    assert seed.schema == CURRENCY_PAIRS_SEED
    assert seed.exceptAll(pairs_reference(spark)).count() == 0


def test_calendar_reference(spark):
    cal = calendar_reference(spark, dt.datetime(2024, 1, 1))
    days = sorted(r.scheduled_timestamp.day for r in cal.collect())
    assert days == [4, 8, 11, 15, 22] and cal.where(F.col("created_at").isNull()).count() == 0


def test_counters_observed_without_extra_scan(spark):
    obs = Observation("ticks")
    df = FI.with_counters(raw_ticks(spark, SF_SMALL), obs, "transaction_timestamp")
    n = df.count()
    assert obs.get["rows"] == n and obs.get["null_pairs"] >= 1


def test_kafka_records_keyed_by_pair(spark):
    rec = to_kafka_records(raw_ticks(spark, SF_SMALL)).where("key = 'ECR/MRT'").first()
    assert '"currency_pair":"ECR/MRT"' in rec.value and '"bid_price":"' in rec.value


def test_event_stream_from_files(spark):
    ev = economic_events(spark, SF_SMALL)
    src = scratch_path(spark, "events_wire")
    ev.select(*[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c) if c.endswith("_timestamp") else F.col(c)
                for c in ev.columns]).write.json(src)
    q = (read_event_stream(spark, path=src).writeStream.format("memory").queryName("ev_stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select event_id, start_timestamp, end_timestamp, affected_currencies from ev_stream")
    assert got.exceptAll(ev.select("event_id", "start_timestamp", "end_timestamp", "affected_currencies")).count() == 0
    assert got.count() == ev.count()


def test_materialize_sorted_partitioned_and_file_listing(spark):
    path = scratch_path(spark, "mat")
    df = raw_ticks(spark, SF_SMALL).withColumn("partition", F.date_format("transaction_timestamp", "yyyy-MM"))
    FI.materialize(df, path, partition_by="partition", sort_by=["currency_pair", "transaction_timestamp"])
    files = FI.table_files(spark.read.parquet(path))
    assert files.agg(F.sum("record_count")).first()[0] == df.count()


def test_compact_rewrites_partition_into_fewer_files(spark):
    from candlewick.plans.incremental import read_partitioned
    path = scratch_path(spark, "compact")
    df = raw_ticks(spark, SF_SMALL).withColumn("partition", F.date_format("transaction_timestamp", "yyyy-MM"))
    df.repartition(8).write.partitionBy("partition").parquet(path)
    before = FI.table_files(read_partitioned(spark, path)).count()
    FI.compact(spark, path, "partition", ["2024-01"], sort_by=["transaction_timestamp"])
    back = read_partitioned(spark, path)
    assert FI.table_files(back).count() < before
    assert back.exceptAll(df.select(*back.columns)).count() == 0 and back.count() == df.count()


def test_store_failures_writes_failing_rows(spark):
    from candlewick.operators import quality as Q
    from candlewick.operators.staging import typed_ticks
    path = scratch_path(spark, "dq")
    checks = [Q.Check("accepted_values", ("trader_type",), values=("retail",))]
    Q.store_failures(typed_ticks(raw_ticks(spark, SF_SMALL)), checks, path, "stg")
    got = spark.read.parquet(f"{path}/stg/accepted_values_0")
    assert got.count() > 0 and got.where("trader_type = 'retail'").count() == 0
