"""DataFrame operators: staging, candles, joins, statistics, windows, quality."""
