from collections import defaultdict

import pytest
from conftest import SF_SMALL

from candlewick.plans.views import register_views


def test_views_agree_with_plain_python_over_the_ticks(spark):
    register_views(spark, SF_SMALL)
    ticks = [r.asDict() for r in spark.table("stg_fx_ticks").collect()]
    by_day = defaultdict(list)
    for t in ticks:
        by_day[t["currency_pair"], t["transaction_timestamp"].date()].append(t)
    daily = spark.sql("SELECT currency_pair, cast(candle_timestamp AS date) AS day, open_price, close_price, high_price, "
                      "low_price, total_volume, trade_count FROM ohlc_candles_1d").collect()
    assert len(daily) == len(by_day)
    for c in daily:
        own = sorted(by_day[c.currency_pair, c.day], key=lambda t: (t["transaction_timestamp"], t["tick_id"]))
        prices = [t["trade_price"] for t in own]
        assert (c.open_price, c.close_price, c.high_price, c.low_price) == (prices[0], prices[-1], max(prices), min(prices))
        assert c.total_volume == sum(t["volume"] for t in own) and c.trade_count == len(own)


def test_grains_and_events_add_up_in_sql(spark):
    register_views(spark, SF_SMALL, prefix="v_")
    sums = spark.sql(" UNION ALL ".join(f"SELECT sum(total_volume) AS v, sum(trade_count) AS n FROM v_ohlc_candles_{iv}"
                                        for iv in ("1min", "5min", "1h", "1d"))).collect()
    assert len({(r.v, r.n) for r in sums}) == 1
    widest = spark.sql("SELECT max(price_range) AS r FROM v_ohlc_candles_1h").first().r
    assert widest == max(r.high_price - r.low_price for r in spark.table("v_ohlc_candles_1h").collect())
    errors = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_type = 'error'").count()
    assert spark.table("v_economic_events").count() == errors > 0
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.sql("SELECT * FROM v_missing")
