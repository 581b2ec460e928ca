import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from candlewick.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4, app_name="candlewick-tests",
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="candlewick-test-wh-")})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="candlewick-test-ckpt-"))
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


RAW_DDL = ("tick_id string, transaction_timestamp timestamp_ntz, currency_pair string, bid_price double, "
           "ask_price double, mid_price double, spread_bps double, trade_price double, volume double, "
           "exchange_location string, trader_type string, event_time timestamp_ntz")


def raw_rows(spark, rows):
    """rows: dicts with overrides on a valid default tick."""
    base = dict(tick_id="t", transaction_timestamp=ts("2024-01-01 00:00:00"), currency_pair="ECR/MRT",
                bid_price=1.0, ask_price=1.002, mid_price=1.001, spread_bps=20.0, trade_price=1.001, volume=10.0,
                exchange_location="Earth_FX_Hub", trader_type="retail", event_time=None)
    out = []
    for r in rows:
        d = {**base, **r}
        if d["event_time"] is None:
            d["event_time"] = d["transaction_timestamp"]
        out.append(tuple(d[k] for k in base))
    return spark.createDataFrame(out, RAW_DDL)
