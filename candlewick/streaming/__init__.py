"""Structured Streaming: tick/event sources, ingest sink, streaming candles."""
