from candlewick.functions.columns import (  # noqa: F401
    bucket, duration_minutes, grid_floor_literal, impact_label, interval_minutes, micros_between,
    ntz_lit, pair_format_ok, partition_value, quote_from_mid, scale_effect, scale_shock, spread_bps,
)
