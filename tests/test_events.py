from conftest import SF_SMALL, raw_rows, ts

from candlewick.operators import events as EV
from candlewick.operators.staging import stage_ticks
from candlewick.sources.fixtures import economic_events, raw_ticks

EV_DDL = ("event_id string, event_type string, event_timestamp timestamp_ntz, start_timestamp timestamp_ntz, "
          "end_timestamp timestamp_ntz, severity long, affected_currencies array<string>, spread_multiplier double, "
          "volatility_multiplier double, volume_multiplier double")


def _events(spark, rows):
    return spark.createDataFrame(rows, EV_DDL)


def test_closed_interval_and_both_currencies_counted_once(spark):
    t = stage_ticks(raw_rows(spark, [dict(tick_id="start", transaction_timestamp=ts("2024-01-01 10:00:00")),
                                     dict(tick_id="end", transaction_timestamp=ts("2024-01-01 12:00:00")),
                                     dict(tick_id="after", transaction_timestamp=ts("2024-01-01 12:00:00.000001"))]))
    e = _events(spark, [("E1", "X", ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"), ts("2024-01-01 12:00:00"),
                         3, ["ECR", "MRT"], 1.5, 2.0, 1.25)])
    for bound in (10, 0):   # broadcast path and shuffle path
        pairs = {(r.tick_id, r.event_id) for r in EV.active_events_join(t, e, max_broadcast_rows=bound).collect()}
        assert pairs == {("start", "E1"), ("end", "E1")}
        imp = {r.tick_id: (r.active_events, r.volatility_factor) for r in
               EV.event_impact(t, e, max_broadcast_rows=bound).collect()}
        assert imp == {"start": (1, 2.0), "end": (1, 2.0), "after": (0, 1.0)}


def test_broadcast_and_shuffle_paths_agree_on_fixture(spark):
    t = stage_ticks(raw_ticks(spark, SF_SMALL))
    e = economic_events(spark, SF_SMALL)
    a = EV.active_events_join(t, e)
    b = EV.active_events_join(t, e, max_broadcast_rows=0)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hour_profile_and_peak(spark):
    t = stage_ticks(raw_rows(spark, [dict(tick_id="noon", transaction_timestamp=ts("2024-01-01 12:30:00")),
                                     dict(tick_id="night", transaction_timestamp=ts("2024-01-01 02:30:00"))]))
    got = {r.tick_id: (r.hour_volume_multiplier, r.is_peak_hour) for r in EV.with_hour_profile(t).collect()}
    assert got == {"noon": (1.5, True), "night": (0.2, False)}


def test_scaled_price_shock(spark):
    from pyspark.sql import functions as F
    e = _events(spark, [("E", "X", None, None, None, 4, ["MRT"], 2.0, 3.0, 1.0)])
    e = e.withColumn("price_shock_percent", F.lit(25.0)).union(
        e.withColumn("price_shock_percent", F.lit(None).cast("double")).withColumn("event_id", F.lit("F")))
    got = {r.event_id: r.scaled_price_shock_percent for r in EV.scaled_effects(e).collect()}
    assert got == {"E": 20.0, "F": None}


def test_scaled_effects(spark):
    e = _events(spark, [("E", "X", None, None, None, 5, ["MRT"], 2.0, 3.0, 1.0),
                        ("F", "X", None, None, None, 1, ["MRT"], 2.0, 3.0, 1.0)])
    got = {r.event_id: (r.scaled_spread_multiplier, r.scaled_volatility_multiplier)
           for r in EV.scaled_effects(e).collect()}
    assert got == {"E": (2.0, 3.0), "F": (1.2, 1.4)}


def test_interval_join_does_not_shuffle_ticks_when_broadcast(spark):
    t = stage_ticks(raw_ticks(spark, SF_SMALL))
    plan = EV.event_impact(t, economic_events(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_bucketed_join_equals_nested_loop_join(spark):
    from pyspark.sql import functions as F
    t = stage_ticks(raw_ticks(spark, SF_SMALL))
    e = economic_events(spark, SF_SMALL)
    cond = ((e.start_timestamp <= t.transaction_timestamp) & (t.transaction_timestamp <= e.end_timestamp) &
            (F.array_contains(e.affected_currencies, t.base_currency) |
             F.array_contains(e.affected_currencies, t.quote_currency)))
    nested = t.join(e, cond).select(t.tick_id, e.event_id)
    ours = EV.active_events_join(t, e).select("tick_id", "event_id")
    assert nested.count() > 0
    assert nested.exceptAll(ours).count() == 0 and ours.exceptAll(nested).count() == 0


def _join_rows(plan):
    """Rows that the joins of an executed plan gave."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _join_rows(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _join_rows(plan.plan())
    own = plan.metrics().apply("numOutputRows").value() if "Join" in plan.nodeName() else 0
    return own + sum(_join_rows(plan.children().apply(i)) for i in range(plan.children().size()))


def test_interval_join_joins_arrays_and_gives_every_pair(spark):
    t = stage_ticks(raw_rows(spark, [dict(tick_id=f"t{i}", transaction_timestamp=ts("2024-01-01 10:00:00")) for i in range(20)]))
    lists = (["ECR", "MRT"], ["MRT", "MRT", None], ["AMC"], None)   # both sides, quote alone and repeated, neither, none
    e = _events(spark, [(f"E{i}", "X", None, ts("2024-01-01 09:30:00"), ts(f"2024-01-01 {'10:30' if i % 2 else '09:45'}:00"), 3,
                         lists[i % 8 // 2], 1.5, None, 1.25) for i in range(2400)] * 2)
    want = {f"E{i}" for i in range(2400) if i % 2 and i % 8 // 2 < 2}
    for bound in (200_000, 0):   # broadcast path and shuffle path
        j = EV.active_events_join(t, e, max_broadcast_rows=bound).select("tick_id", "event_id")
        per = {(r.tick_id, r.event_id): r["count"] for r in j.groupBy("tick_id", "event_id").count().collect()}
        assert per == {(f"t{i}", event): 2 for i in range(20) for event in want}
        pairs = len(j.collect())
        assert pairs == 24_000 and 0 < _join_rows(j._jdf.queryExecution().executedPlan()) < pairs / 20
