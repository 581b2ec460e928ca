import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.functions import columns as FC


def test_interval_and_partition_validation():
    assert FC.interval_minutes("5min") == 5 and FC.interval_minutes("1d") == 1440
    with pytest.raises(ValueError):
        FC.interval_minutes("2min")
    with pytest.raises(ValueError):
        FC.partition_value("ts", "week")


def test_grid_floor_literal_matches_bucket(spark):
    t = dt.datetime(2024, 3, 5, 13, 47, 31, 123456)
    df = spark.createDataFrame([(t,)], "ts timestamp_ntz")
    for iv in ("1min", "5min", "15min", "1h", "4h", "1d"):
        assert df.select(FC.bucket("ts", iv)).first()[0] == FC.grid_floor_literal(t, iv), iv


def test_duration_truncates_toward_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 2, 59)),
                                (dt.datetime(2024, 1, 1, 10, 2, 59), dt.datetime(2024, 1, 1, 10, 0))],
                               "s timestamp_ntz, e timestamp_ntz")
    assert [r[0] for r in df.select(FC.duration_minutes("s", "e")).collect()] == [2, -2]


def test_impact_label_and_pair_format(spark):
    df = spark.createDataFrame([(1, "ECR/MRT"), (5, "ECRMRT"), (9, "A/B/C")], "sev int, pair string")
    rows = df.select(FC.impact_label("sev").alias("l"), FC.pair_format_ok("pair").alias("ok")).collect()
    assert rows[0].l == "Minor market disruption expected" and rows[1].l.startswith("Critical")
    assert rows[2].l is None
    assert [r.ok for r in rows] == [True, False, False]


def test_spread_and_quote(spark):
    df = spark.createDataFrame([(0.999, 1.001, 1.0, 7.0), (1.0, 1.0, 0.0, 7.0)], "b double, a double, m double, s double")
    got = [r[0] for r in df.select(F.round(FC.spread_bps("b", "a", "m", "s"), 9)).collect()]
    assert got == [20.0, 7.0]           # mid <= 0 keeps the existing value
    bid, ask = FC.quote_from_mid(F.lit(2.0), F.lit(10.0))
    r = spark.range(1).select(bid.alias("b"), ask.alias("a")).first()
    assert float(r.b) == 1.999 and float(r.a) == 2.001


def test_ntz_literal_is_zone_free(spark):
    t = dt.datetime(2024, 1, 1, 0, 30)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = spark.range(1).select(FC.ntz_lit(t)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == t
