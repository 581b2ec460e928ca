from candlewick.sources.fixtures import raw_ticks, economic_events, read_table  # noqa: F401
