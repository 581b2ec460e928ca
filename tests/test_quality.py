import pytest
from conftest import raw_rows, ts

from candlewick.operators import quality as Q
from candlewick.operators.candles import ohlc_candles
from candlewick.operators.staging import stage_ticks, typed_ticks
from candlewick.schemas import STAGED_TICK


def test_dq_report_counts(spark):
    raw = raw_rows(spark, [dict(tick_id="a", trader_type="alien"), dict(tick_id="a"),
                           dict(tick_id="b", currency_pair="XXX/YYY"), dict(tick_id=None)])
    rep = {(r.check, r.column): r.failures for r in Q.dq_report(typed_ticks(raw), Q.staging_checks()).collect()}
    assert rep[("unique", "tick_id")] == 1 and rep[("not_null", "tick_id")] == 1
    assert rep[("accepted_values", "trader_type")] == 1 and rep[("accepted_values", "currency_pair")] == 1
    assert rep[("accepted_values", "base_currency")] == 1


def test_run_checks_raises_on_error(spark):
    raw = raw_rows(spark, [dict(tick_id="a"), dict(tick_id="a")])
    with pytest.raises(AssertionError):
        Q.run_checks(typed_ticks(raw), Q.staging_checks(), raise_on_error=True)


def test_candle_checks_pass_and_violations_empty(spark):
    c = ohlc_candles(stage_ticks(raw_rows(spark, [dict(tick_id="a")])), "1min")
    assert all(r.failures == 0 for r in Q.dq_report(c, Q.candle_checks("1min")).collect())
    assert Q.ohlc_violations({"c": c}).count() == 0


def test_freshness_levels(spark):
    s = stage_ticks(raw_rows(spark, [dict(tick_id="a", event_time=ts("2024-01-01 00:00:00"))]))
    st = {m: Q.freshness(s, ts(f"2024-01-01 00:{m:02d}:00")).first().status for m in (3, 10, 20)}
    assert st == {3: "pass", 10: "warn", 20: "error"}


def test_schema_contract(spark):
    s = stage_ticks(raw_rows(spark, [dict(), dict()]))
    assert s.schema == STAGED_TICK and Q.schema_report(s, s).count() == 0
    got = {r.column: (r.change, r.breaking, r.rows) for r in Q.schema_report(s, s.drop("volume").withColumn("bid_price", s.bid_price.cast("double")).withColumn("extra", s.tick_id)).collect()}
    assert got == {"extra": ("added", False, 2), "volume": ("removed", True, 2), "bid_price": ("retyped", True, 2)}


def test_trade_outside_quote(spark):
    s = stage_ticks(raw_rows(spark, [dict(tick_id="in"), dict(tick_id="out", trade_price=1.5)]))
    assert [r.tick_id for r in Q.trade_outside_quote(s).collect()] == ["out"]


def test_layered_tick_report_equals_separate_reports(spark):
    from conftest import SF_SMALL

    from candlewick.sources.fixtures import raw_ticks
    raw = raw_ticks(spark, SF_SMALL)
    raw = raw.unionByName(raw.limit(3))            # some duplicate tick ids in both layers
    fused = Q.dq_report_ticks(raw)
    separate = Q.dq_report(raw, Q.source_checks(), "raw_ticks").unionByName(
        Q.dq_report(stage_ticks(raw), Q.staging_checks(), "stg_fx_ticks"))
    assert fused.exceptAll(separate).count() == 0 and separate.exceptAll(fused).count() == 0
    assert fused.where("check = 'unique' and failures > 0").count() == 2
