"""Column-expression helpers (the macro layer): each returns a ``Column`` so it
stays inside whole-stage codegen.  No Python UDFs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from candlewick.constants import IMPACT_LABELS

PRICE_DEC = DecimalType(18, 8)
SPREAD_DEC = DecimalType(8, 2)

_MINUTES = {"1min": 1, "5min": 5, "15min": 15, "30min": 30, "1h": 60, "4h": 240, "1d": 1440}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def interval_minutes(interval: str) -> int:
    """Minutes in a candle grain; unknown grain raises ValueError."""
    try:
        return _MINUTES[interval]
    except KeyError:
        raise ValueError(f"unsupported interval {interval!r}; use one of {sorted(_MINUTES)}") from None


def bucket(ts, interval: str) -> Column:
    """Floor a TIMESTAMP_NTZ to the candle grid (epoch-aligned).

    Built from the timestamp's fields with ``make_timestamp_ntz`` so it is
    time-zone independent, keeps the NTZ type and can be used several times in
    one projection (``window()`` cannot)."""
    ts = _c(ts)
    m = interval_minutes(interval)
    y, mo, d, h, mi = F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts)
    zero = F.lit(0)
    if m < 60:
        return F.make_timestamp_ntz(y, mo, d, h, mi - mi % m, zero)
    if m < 1440:
        hours = m // 60
        return F.make_timestamp_ntz(y, mo, d, h - h % hours, zero, zero)
    return F.make_timestamp_ntz(y, mo, d, zero, zero, zero)


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal that does not depend on any time zone (a
    Python datetime passed to ``lit`` would become a zoned TIMESTAMP)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def grid_floor_literal(t: _dt.datetime, interval: str) -> _dt.datetime:
    """Driver-side floor of a Python datetime to the same grid as ``bucket``."""
    m = interval_minutes(interval)
    t = t.replace(second=0, microsecond=0)
    if m < 60:
        return t.replace(minute=t.minute - t.minute % m)
    if m < 1440:
        h = m // 60
        return t.replace(hour=t.hour - t.hour % h, minute=0)
    return t.replace(hour=0, minute=0)


def micros_between(start, end) -> Column:
    """Exact microseconds from start to end (works on NTZ without a zone)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def spread_bps(bid, ask, mid, fallback=None) -> Column:
    """((ask-bid)/mid)*10000 when mid > 0, else the fallback (existing value)."""
    bid, ask, mid = _c(bid), _c(ask), _c(mid)
    val = (ask - bid) / mid * F.lit(10000)
    fb = F.lit(None) if fallback is None else _c(fallback)
    return F.when(mid > 0, val).otherwise(fb)


def quote_from_mid(mid, bps) -> tuple[Column, Column]:
    """Bid/ask from a mid and a spread in bps: mid -/+ mid*bps/20000,
    quantised half-even to 8 decimals."""
    mid, bps = _c(mid).cast("double"), _c(bps).cast("double")
    half = mid * bps / F.lit(20000.0)
    bid = F.bround(mid - half, 8).cast(PRICE_DEC)
    ask = F.bround(mid + half, 8).cast(PRICE_DEC)
    return bid, ask


def scale_effect(multiplier, severity) -> Column:
    """Severity-scaled multiplier: 1 + (m - 1) * severity / 5."""
    return F.lit(1.0) + (_c(multiplier) - F.lit(1.0)) * _c(severity) / F.lit(5.0)


def scale_shock(shock, severity) -> Column:
    """Severity-scaled price shock: shock * severity / 5."""
    return _c(shock) * _c(severity) / F.lit(5.0)


def impact_label(severity) -> Column:
    """Expected-impact text for severity 1..5 (NULL outside)."""
    pairs = []
    for k in sorted(IMPACT_LABELS):
        pairs += [F.lit(k), F.lit(IMPACT_LABELS[k])]
    return F.try_element_at(F.create_map(*pairs), _c(severity).cast("int"))


def duration_minutes(start, end) -> Column:
    """Whole minutes between start and end, truncated toward zero."""
    us = micros_between(start, end)
    return F.when(us >= 0, F.floor(us / F.lit(60_000_000))).otherwise(F.ceil(us / F.lit(60_000_000))).cast("long")


def pair_format_ok(pair) -> Column:
    """True when a pair symbol looks like BASE/QUOTE."""
    return _c(pair).rlike(r"^[^/]+/[^/]+$")


_PARTITION_FORMATS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
PARTITION_FOR_INTERVAL = {"1min": "hour", "5min": "day", "1h": "month", "1d": "year"}


def partition_value(ts, transform: str) -> Column:
    """Partition transform hour/day/month/year of a timestamp as a string column."""
    try:
        fmt = _PARTITION_FORMATS[transform]
    except KeyError:
        raise ValueError(f"unsupported partition transform {transform!r}") from None
    return F.date_format(_c(ts), fmt)


# partition columns written next to a timestamp by our sinks: (name, kind)
_TIME_PARTITIONS = (("date", "date"), ("transaction_date", "date"), ("partition_date", "date"))


def since_predicate(df_columns, ts: str, since) -> Column:
    """``ts >= since`` plus, when the table carries a date partition column
    written from that timestamp, ``date >= date(since)`` so whole folders are
    pruned (the timestamp filter alone only prunes row groups)."""
    cond = F.col(ts) >= ntz_lit(since)
    day = (since if isinstance(since, _dt.datetime) else _dt.datetime.fromisoformat(str(since))).date()
    for name, _ in _TIME_PARTITIONS:
        if name in df_columns:
            cond = cond & (F.col(name) >= F.lit(day))
    return cond
