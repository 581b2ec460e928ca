"""Report projection used by registered queries: decimals become doubles and
averages/ratios are rounded to 6 decimals, so results compare across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# averages differ by engine (exact decimal vs double) -> rounded; the ratio
# columns are the same IEEE double operations in every engine -> left exact
# (rounding identical doubles can still split a tie differently by engine)
CANDLE_ROUNDED = ("avg_trade_volume", "avg_spread_bps")


def report(df: DataFrame, rounded=(), drop=("calculated_at",), digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        if f.name in rounded:
            c = F.round(c.cast("double"), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def candle_report(df: DataFrame) -> DataFrame:
    return report(df, rounded=CANDLE_ROUNDED)
