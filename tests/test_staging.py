from conftest import raw_rows, ts

from candlewick.operators import staging as ST
from candlewick.sources.wire import parse_raw_ticks, to_wire


def test_quality_filter_cases(spark):
    raw = raw_rows(spark, [dict(tick_id="nullbid", bid_price=None),
                           dict(tick_id="equal", bid_price=1.0, ask_price=1.0),
                           dict(tick_id="crossed", bid_price=1.002, ask_price=1.0),
                           dict(tick_id="zerovol", volume=0.0),
                           dict(tick_id="nopair", currency_pair=None),
                           dict(tick_id="ok")])
    kept = {r.tick_id for r in ST.stage_ticks(raw).collect()}
    assert kept == {"equal", "ok"}
    rej = {r.tick_id: set(r.reject_reasons) for r in ST.rejected_ticks(raw).collect()}
    assert rej == {"nullbid": {"bid_price_not_positive", "ask_below_bid"}, "crossed": {"ask_below_bid"},
                   "zerovol": {"volume_not_positive"}, "nopair": {"pair_missing"}}


def test_pair_without_slash_has_empty_quote(spark):
    r = ST.typed_ticks(raw_rows(spark, [dict(currency_pair="ECRMRT")])).first()
    assert r.base_currency == "ECRMRT" and r.quote_currency == ""


def test_business_key_dedup_removes_replay(spark):
    raw = raw_rows(spark, [dict(tick_id="a"), dict(tick_id="b"),
                           dict(tick_id="c", transaction_timestamp=ts("2024-01-01 00:00:01"))])
    s = ST.stage_ticks(raw)
    assert ST.dedup_ticks(s).count() == 3  # unique(tick_id) passes
    bk = ("currency_pair", "transaction_timestamp", "trade_price", "volume")
    got = ST.dedup_ticks(s, keys=bk)
    assert sorted(r.tick_id for r in got.collect()) == ["a", "c"]
    assert got.exceptAll(ST.dedup_ticks_window(s, keys=bk)).count() == 0


def test_wire_roundtrip_and_bad_text(spark):
    raw = raw_rows(spark, [dict(tick_id="a", bid_price=1.23456789)])
    back = parse_raw_ticks(to_wire(raw)).first()
    assert back.bid_price == 1.23456789 and back.transaction_timestamp == ts("2024-01-01 00:00:00")
    w = to_wire(raw).withColumn("volume", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("n/a"))
    bad = parse_raw_ticks(w, keep_bad=True).first()
    assert bad.volume is None and bad._bad == ["volume"]


def test_recent_filter_reaches_scan(spark, tmp_path):
    raw = raw_rows(spark, [dict(tick_id="a")])
    raw.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = ST.recent(df, ts("2024-01-02 00:00:00"), 60)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(transaction_timestamp" in plan


def test_wire_parse_is_session_zone_independent(spark):
    from candlewick.sources.wire import utc_ntz
    df = spark.createDataFrame([("2024-01-01T10:00:00.000000+02:00", "2024-01-01T10:00:00.000000")], "a string, b string")
    for tz in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", tz)   # plans are analysed in the session zone
        try:
            got = df.select(utc_ntz(df.a, tz).alias("a"), utc_ntz(df.b, tz).alias("b")).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got.a == ts("2024-01-01 08:00:00") and got.b == ts("2024-01-01 10:00:00"), tz
