"""Tables kept up from run to run: snapshots, appends, check states, carried tails, late rows, live enrichment, counters."""

import datetime as dt

import pytest
from conftest import SF_SMALL, raw_rows, ts
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from candlewick.functions.columns import ntz_lit, partition_value
from candlewick.operators import events as EV
from candlewick.operators import quality as Q
from candlewick.operators.candles import ohlc_candles
from candlewick.operators.staging import stage_ticks
from candlewick.operators.stats import pair_correlation, realized_vol
from candlewick.plans import colocated as CO
from candlewick.plans import incremental as INC
from candlewick.plans import snapshots as SN
from candlewick.plans import volatility as VOL
from candlewick.plans.registry import _IMPACT_COLS
from candlewick.sources import wire as W
from candlewick.sources.fixtures import economic_events, raw_ticks
from candlewick.streaming.enrich import stream_event_join
from candlewick.streaming.ingest import read_event_stream, read_tick_stream
from candlewick.streaming.late import keep_batch

TS = "transaction_timestamp"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ------------------------------------------------------------ event sweep
def test_sweep_equals_products_over_pairs_in_any_number_of_chunks(spark):
    t, e = stage_ticks(raw_ticks(spark, SF_SMALL)), economic_events(spark, SF_SMALL)
    t = t.unionByName(t.limit(50))
    lists = EV.event_impact(t, e, max_factor_values=0).select(*_IMPACT_COLS)
    assert lists.agg(F.max("active_events")).first()[0] > 1
    for chunks in (1, 3, 17):
        assert same(EV.event_impact(t, e, n_chunks=chunks).select(*_IMPACT_COLS), lists)


def test_sweep_at_one_instant_and_odd_values(spark):
    ddl = ("event_id string, event_type string, event_timestamp timestamp_ntz, start_timestamp timestamp_ntz, end_timestamp timestamp_ntz, severity long, "
           "affected_currencies array<string>, spread_multiplier double, volatility_multiplier double, volume_multiplier double")
    at, later = ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00")
    rows = [("a", "X", at, at, at, 1, ["ECR", "ECR"], 2.0, 0.0, None), ("b", "X", at, at, later, 1, ["MRT"], -1.5, 1.0, 0.5),
            ("c", "X", at, later, at, 1, ["MRT"], 9.0, 9.0, 9.0), ("d", "X", at, later, later, 1, [], 9.0, 9.0, 9.0)]  # c ends before it starts
    ticks = stage_ticks(raw_rows(spark, [dict(tick_id=f"t{k}", transaction_timestamp=at) for k in range(5)]
                                 + [dict(tick_id="u", transaction_timestamp=later), dict(tick_id="v", transaction_timestamp=later, currency_pair="LCR/AMC")]))
    for chunks in (1, 4):
        got = {r.tick_id: (r.active_events, r.spread_factor, r.volatility_factor, r.volume_factor)
               for r in EV.event_impact(ticks, spark.createDataFrame(rows, ddl), n_chunks=chunks).collect()}
        assert got == {**{f"t{k}": (2, -3.0, 0.0, 0.5) for k in range(5)}, "u": (1, -1.5, 1.0, 0.5), "v": (0, 1.0, 1.0, 1.0)}
    none = EV.event_impact(ticks, spark.createDataFrame([], ddl))
    assert none.count() == 7 and none.where("active_events <> 0 or spread_factor <> 1").count() == 0


def test_sweep_makes_no_lists_and_no_pairs(spark):
    plan = EV.event_impact(stage_ticks(raw_ticks(spark, SF_SMALL)), economic_events(spark, SF_SMALL), max_broadcast_rows=0)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


# ------------------------------------------------------------ snapshots
def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string, partition string")


def _versions_as_set(spark, path):
    return {(r.k, r.v, r.valid_from.day, r.valid_to and r.valid_to.day) for r in INC.read_partitioned(spark, path).collect()}


def test_snapshot_opens_changes_closes_and_comes_back(spark, tmp_path):
    path, day = str(tmp_path / "s"), lambda d: dt.datetime(2024, 1, d)
    assert SN.snapshot_run(spark, path, _rows(spark, (1, "a", "p"), (2, None, "p"), (3, "c", "q")), ["k"], day(1)) == {"opened": 3, "changed": 0, "closed": 0}
    second = _rows(spark, (1, "a", "p"), (2, "b", "p"), (4, "d", "r"))
    assert SN.snapshot_run(spark, path, second, ["k"], day(2)) == {"opened": 1, "changed": 1, "closed": 1}
    assert SN.snapshot_run(spark, path, second, ["k"], day(3)) == {"opened": 0, "changed": 0, "closed": 0}  # a repeated run
    SN.snapshot_run(spark, path, _rows(spark, (1, "a", "p"), (2, None, "p"), (3, "c", "q"), (4, "d", "r")), ["k"], day(4))
    got = _versions_as_set(spark, path)
    assert got == {(1, "a", 1, None), (2, None, 1, 2), (2, "b", 2, 4), (2, None, 4, None), (3, "c", 1, 2), (3, "c", 4, None), (4, "d", 2, None)}
    SN.snapshot_run(spark, path, second.limit(0), ["k"], day(5))
    assert all(to is not None for *_, to in _versions_as_set(spark, path))


def test_snapshot_of_some_partitions_leaves_the_others(spark, tmp_path):
    path, day = str(tmp_path / "s"), lambda d: dt.datetime(2024, 1, d)
    SN.snapshot_run(spark, path, _rows(spark, (1, "a", "p"), (2, "b", "q")), ["k"], day(1))
    told = SN.snapshot_run(spark, path, _rows(spark, (1, "x", "p"), (9, "left out", "q")), ["k"], day(2), partitions=["p"])
    assert told == {"opened": 0, "changed": 1, "closed": 0}
    assert _versions_as_set(spark, path) == {(1, "a", 1, 2), (1, "x", 2, None), (2, "b", 1, None)}


@pytest.mark.parametrize("rows", [((1, "a", "p"), (1, "b", "p")), ((None, "a", "p"),)])
def test_repeated_and_null_keys_are_refused(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    with pytest.raises(AssertionError, match="key"):
        SN.snapshot_run(spark, path, _rows(spark, *rows), ["k"], dt.datetime(2024, 1, 1))
    _rows(spark, (1, "old", "p")).write.partitionBy("partition").parquet(path)
    with pytest.raises(AssertionError, match="key"):
        INC.upsert_path(spark, path, _rows(spark, *rows), ["k"])
    assert [r.v for r in INC.read_partitioned(spark, path).collect()] == ["old"]


# ------------------------------------------------------------ appends
def test_append_stores_each_id_once_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "ticks")
    day = lambda d, h=1: ts(f"2024-01-{d:02d} {h:02d}:00:00")
    def batch(*ids):
        return stage_ticks(raw_rows(spark, [dict(tick_id=i, transaction_timestamp=at) for i, at in ids]))
    INC.append_new(spark, path, batch(("a", day(1)), ("b", day(1)), ("b", day(1, 2))), "1")
    INC.append_new(spark, path, batch(("a", day(2)), ("c", day(2)), ("d", day(3))), "2")  # a comes again a day later
    INC.append_new(spark, path, batch(("c", day(2))), "3")
    for _ in range(2):
        INC.append_new(spark, path, batch(("a", day(2)), ("c", day(2)), ("d", day(3))), "2")
    got = sorted((r.tick_id, r.transaction_timestamp.day, r.batch) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, 1), ("b", 1, 1), ("c", 2, 2), ("d", 3, 2)]
    INC.append_new(spark, path, batch(("a", day(9))).limit(0), "4")
    plan = spark.read.parquet(path).where(F.col("date").isin([dt.date(2024, 1, 2)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date" in plan.split("PartitionFilters: [")[1][:60]


# ------------------------------------------------------------ co-located merge
def test_merge_moves_the_update_alone(spark):
    ddl = "k int, v string, partition string"
    CO.create_bucketed(spark.createDataFrame([(k, "old", "pq"[k % 2]) for k in range(100)], ddl), "colocated_test", ["k"], buckets=4)
    updates = spark.createDataFrame([(k, "new", "p") for k in range(90, 110, 2)], ddl)
    plan = CO.merged_rows(spark, "colocated_test", updates, ["p"], ["k"])._jdf.queryExecution().executedPlan().toString()
    target = plan[plan.index("FileScan parquet"):]
    above = plan[:plan.index("FileScan parquet")]
    assert "SelectedBucketsCount: 4 out of 4" in target and "Bucketed: true" in target and "SortMergeJoin" in above
    assert "Exchange" not in above[above.index("SortMergeJoin"):]  # between the join and the target's scan
    CO.upsert_bucketed(spark, "colocated_test", updates, ["k"])
    got = {r.k: (r.v, r.partition) for r in spark.table("colocated_test").collect()}
    assert got == {**{k: ("old", "pq"[k % 2]) for k in range(100)}, **{k: ("new", "p") for k in range(90, 110, 2)}}
    assert CO.bucket_count(spark, "colocated_test") == 4
    for bad in (updates.unionByName(updates), updates.withColumn("k", F.lit(None).cast("int")), updates.drop("v")):
        with pytest.raises(AssertionError):
            CO.upsert_bucketed(spark, "colocated_test", bad, ["k"])
    spark.sql("DROP TABLE colocated_test")


# ------------------------------------------------------------ check states
def test_states_merge_to_the_report_also_for_keys_repeated_across_partitions(spark, tmp_path):
    raw = raw_ticks(spark, SF_SMALL)
    raw = raw.unionByName(raw.limit(7).withColumn(TS, F.col(TS) + F.expr("INTERVAL 9 DAYS"))).unionByName(raw.limit(3))
    raw = raw.withColumn("partition", partition_value(TS, "day"))
    path, checks = str(tmp_path / "st"), [*Q.source_checks(), Q.Check("unique_combination", ("tick_id", "currency_pair"))]
    Q.refresh_check_states(raw.withColumn("bid_price", F.lit(None).cast("double")), checks, path)  # all wrong, then put right folder by folder
    days = sorted(r[0] for r in raw.select("partition").distinct().collect())
    for part in (days[::2], days[1::2]):
        Q.refresh_check_states(raw, checks, path, partitions=part)
    want = Q.dq_report(raw, checks, "m")
    assert same(Q.report_from_states(spark, path, checks, "m"), want.select("model", "check", "column", "severity", "failures"))
    assert want.where("check = 'unique'").first()["failures"] == 7


# ------------------------------------------------------------ carried tails
def test_runs_over_parts_equal_one_pass(spark, tmp_path):
    t = stage_ticks(raw_ticks(spark, SF_SMALL)).select("tick_id", "currency_pair", TS, "mid_price")
    path = str(tmp_path / "vol")
    assert VOL.realized_vol_run(spark, t.limit(0), path, n=10) == 0
    for k, cut in enumerate(("2024-01-02", "2024-01-02 12:00:00", "2024-01-20", "2025-01-01"), 1):
        assert VOL.realized_vol_run(spark, t.where(F.col(TS) < ntz_lit(cut)), path, n=10) == k
    assert VOL.realized_vol_run(spark, t, path, n=10) == 4  # nothing new
    cols = ["tick_id", "seq", F.round("realized_volatility", 9).alias("v")]
    assert same(VOL.realized_vol_values(spark, path).select(cols), realized_vol(t, n=10).select(cols))
    tails = spark.read.parquet(f"{path}/tails").where("run = 4")
    assert tails.groupBy("currency_pair").count().agg(F.max("count")).first()[0] <= 9


def test_a_run_that_left_no_tail_is_replaced(spark, tmp_path):
    import shutil
    t = stage_ticks(raw_ticks(spark, SF_SMALL)).select("tick_id", "currency_pair", TS, "mid_price")
    path = str(tmp_path / "vol")
    VOL.realized_vol_run(spark, t.where(F.col(TS) < ntz_lit("2024-01-15")), path)
    VOL.realized_vol_run(spark, t.where(F.col(TS) < ntz_lit("2024-01-20")), path)
    shutil.rmtree(f"{path}/tails/run=2")
    VOL.realized_vol_run(spark, t, path)
    assert same(VOL.realized_vol_values(spark, path).select("tick_id", "seq"), realized_vol(t).select("tick_id", "seq"))


# ------------------------------------------------------------ late rows
def test_every_tick_is_in_a_candle_or_the_side_table_and_batches_can_be_repeated(spark, tmp_path):
    t, root = stage_ticks(raw_ticks(spark, SF_SMALL)), str(tmp_path / "c")
    parts = [t.where(F.col("event_time") < ntz_lit("2024-01-10")), t.where(F.col("event_time").between(ntz_lit("2024-01-10"), ntz_lit("2024-01-19"))),
             t.where(F.col("event_time") > ntz_lit("2024-01-19"))]
    for k, part in enumerate(parts):
        keep_batch(part, k, "1h", root, delay_minutes=60)
        keep_batch(part, k, "1h", root, delay_minutes=60)
    late = spark.read.parquet(f"{root}/late")
    candles = INC.read_partitioned(spark, f"{root}/candles")
    assert late.count() > 0 and late.count() + candles.agg(F.sum("trade_count")).first()[0] == t.count()
    taken = t.join(late, "tick_id", "left_anti")
    want = ohlc_candles(taken, "1h", calculated_at=False)
    assert same(candles.select(want.columns), want)


def test_many_multiplier_values_multiply_along_the_tree_without_tick_event_pairs(spark):
    at = lambda k: ts("2024-01-01 00:00:00") + dt.timedelta(seconds=7 * k)
    ticks = stage_ticks(raw_rows(spark, [dict(tick_id=f"{p}{k}{copy}", currency_pair=p, transaction_timestamp=at(k))
                                         for k in range(150) for p in ("ECR/MRT", "LCR/AMC") for copy in range(1 + k % 2)]))
    ends = [(0, 149), (0, 0), (149, 149), (3, 130), (3, 130), (31, 33), (64, 127), (63, 128), (-5, 500), (150, 160), (-9, -1), (7, 6), (40, 100)]
    ends += [(k * 37 % 150, k * 37 % 150 + k % 60) for k in range(80)]
    events = [(str(k), "X", at(a), at(a), at(b), 1, [["ECR"], ["MRT", "ECR", "ECR"], ["AMC", "XXX"], []][k % 4], 1.0 + k / 1000, None if k % 5 == 0 else 0.9 + k / 999,
               0.0 if k == 5 else -1.0 - k / 998) for k, (a, b) in enumerate(ends)]
    events = spark.createDataFrame(events, economic_events(spark, SF_SMALL).schema)
    pairs = EV.active_events_join(ticks, events).groupBy("tick_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.product(f"event_{c}").alias(name) for c, name in EV.FACTORS.items()])
    want = {r.tick_id: r for r in pairs.collect()}
    for bound, chunks in ((10**6, None), (0, 9)):
        out = EV.event_impact(ticks, events, max_broadcast_rows=bound, n_chunks=chunks, max_factor_values=64)
        got = {r.tick_id: r for r in out.collect()}
        assert len(got) == ticks.count() == 450 and set(want) <= set(got) and len(want) > 400
        for key, r in got.items():
            w = want.get(key)
            assert r.active_events == (w.n if w else 0)
            for name in EV.FACTORS.values():
                one = 1.0 if w is None or w[name] is None else w[name]
                assert r[name] == pytest.approx(one, rel=1e-12), (key, name)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "_bucket" not in plan and "_level" in plan  # no join of ticks with the events of their time bucket


# ------------------------------------------------------------ live enrichment
def _run(spark, tmp_path, ticks, events, files):
    src, own, sink, ck = (str(tmp_path / n) for n in ("t", "e", "out", "ck"))
    for k in (0, 1):
        cut = ntz_lit("2024-01-15")
        before = lambda c: F.col(c) < cut if k == 0 else F.col(c) >= cut
        W.to_wire(ticks.where(before(TS))).repartition(files).write.mode("append").json(src)
        W.events_to_wire(events.where(before("start_timestamp"))).repartition(files).write.mode("append").json(own)
        joined = stream_event_join(stage_ticks(W.parse_raw_ticks(read_tick_stream(spark, path=src))), read_event_stream(spark, path=own))
        (joined.select("tick_id", "event_id").writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
         .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(sink)


@pytest.mark.parametrize("files", [1, 5])
def test_live_join_equals_batch_in_any_file_layout(spark, tmp_path, files):
    raw, events = raw_ticks(spark, SF_SMALL), economic_events(spark, SF_SMALL)
    got = _run(spark, tmp_path, raw, events, files)
    want = EV.active_events_join(stage_ticks(raw), events).select("tick_id", "event_id")
    assert want.count() > 100 and same(got, want)


def test_live_join_meets_by_time_bucket_and_keeps_events_over_many_buckets(spark, tmp_path):
    ticks = raw_rows(spark, [dict(tick_id=str(k), currency_pair=p, transaction_timestamp=ts(f"2024-01-{14 + k // 24:02d} {k % 24:02d}:00:00"))
                             for k in range(48) for p in ("ECR/MRT", "LCR/AMC")])
    spans = [("a", "2024-01-14 03:00:00", "2024-01-14 15:00:00", ["MRT", "ECR"]), ("b", "2024-01-14 05:00:00", "2024-01-14 05:00:00", ["MRT", "MRT"]),
             ("c", "2024-01-14 22:30:00", "2024-01-15 02:00:00", ["AMC"]), ("d", "2024-01-15 01:00:01", "2024-01-15 01:59:59", ["ECR"])]
    events = economic_events(spark, SF_SMALL).limit(0)
    events = spark.createDataFrame([(k, "X", ts(a), ts(a), ts(b), 1, cur, 1.0, 1.0, 1.0) for k, a, b, cur in spans], events.schema)
    got = _run(spark, tmp_path, ticks, events, 1)
    want = EV.active_events_join(stage_ticks(ticks), events).select("tick_id", "event_id")
    assert want.count() == 13 + 1 + 4 and same(got, want)
    live = stream_event_join(stage_ticks(W.parse_raw_ticks(read_tick_stream(spark, path=str(tmp_path / "t")))), read_event_stream(spark, path=str(tmp_path / "e")))
    plan = live._jdf.queryExecution().analyzed().toString()
    assert "_bucket" in plan.split("Join Inner")[1].split("\n")[0]  # ticks meet the events of their own bucket alone


def test_an_event_longer_than_the_bound_is_an_error(spark, tmp_path):
    events = economic_events(spark, SF_SMALL).withColumn("end_timestamp", F.col("start_timestamp") + F.expr("INTERVAL 13 HOURS"))
    with pytest.raises(StreamingQueryException, match="event longer than"):
        _run(spark, tmp_path, raw_ticks(spark, SF_SMALL), events, 1)


# ------------------------------------------------------------ statistics
def test_unknown_pairs_correlate_and_a_list_restricts(spark):
    rows = [dict(tick_id=f"{p}{k}", currency_pair=p, transaction_timestamp=ts(f"2024-01-01 10:{k:02d}:00"), mid_price=1.0 + 0.01 * k * s)
            for p, s in (("AAA/BBB", 1), ("ECR/MRT", -1), ("ZZZ/YYY", 2)) for k in range(6)]
    ticks = stage_ticks(raw_rows(spark, rows))
    got = {(r.pair_a, r.pair_b): (round(r.correlation, 9), r.n_buckets) for r in pair_correlation(ticks).collect()}
    assert got == {("AAA/BBB", "ECR/MRT"): (-1.0, 6), ("AAA/BBB", "ZZZ/YYY"): (1.0, 6), ("ECR/MRT", "ZZZ/YYY"): (-1.0, 6)}
    assert [(r.pair_a, r.pair_b) for r in pair_correlation(ticks, pairs=["ZZZ/YYY", "AAA/BBB"]).collect()] == [("ZZZ/YYY", "AAA/BBB")]
