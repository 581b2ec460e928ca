"""Ordered-sequence operators that stay parallel under key skew.

A plain ``Window.partitionBy(pair).orderBy(ts)`` runs one task per pair —
with six pairs and one pair holding a third of all rows that is one task
over a third of the data.  These helpers split every key into chunks
(default: balanced rank ranges, see below) so window partitions are
(key, chunk) and only a small per-chunk summary table is windowed per key:

* ``lag_across_chunks`` — previous row's values; the first row of a chunk
  takes the last row of the previous non-empty chunk (carried through the
  chunk table).
* ``max_gap`` — largest time step: inner gaps per chunk plus the steps
  between consecutive chunks; never touches rows twice.
* ``sequenced`` — 1-based position per key = row_number in chunk + rows in
  earlier chunks (prefix sum over the chunk table).
* ``rolling_rows`` — frame of the last ``n`` rows computed in fixed-size
  row blocks, each block carrying the ``n - 1`` rows before it, so every
  window partition is bounded by ``block_rows + n``.

Chunking.  ``chunk="1h"`` (any grid grain) cuts by time: one hash shuffle,
but a single hot (key, hour) is still one task.  ``chunk="balanced"`` cuts
by rank instead: rows are range-partitioned on (key, order columns) into
``n_chunks`` ranges, or as many as AQE sizes from the data (the range
sampler splits even one hot key or instant,
because the order columns end with a unique tick id) and the range index is
the chunk.  Range bounds come from a sample, so where the plan reads the
chunked rows twice (carry join) they are checkpointed once in the shared
folder, keeping one chunk assignment for both reads; select the columns you
need before.  Range indices increase with the order inside every key, so
the carry logic is unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import bucket, micros_between
from candlewick.session import checkpoint_dir

BALANCED = "balanced"
DEFAULT_CHUNK = BALANCED


def _with_chunk(df: DataFrame, by, order, chunk: str, n_chunks: int | None = None,
                freeze: bool = False) -> DataFrame:
    if chunk != BALANCED:
        return df.withColumn("_chunk", bucket(order[0], chunk))
    # a row hash as the last range key lets the sampler split even rows whose
    # (key, order) are all equal; without an explicit count AQE sizes the range
    # shuffle from the data (coalescing merges adjacent ranges, ids stay ordered)
    keys = [*by, *order, F.xxhash64(*[F.col(c) for c in df.columns])]
    ranged = df.repartitionByRange(n_chunks, *keys) if n_chunks else df.repartitionByRange(*keys)
    ranged = ranged.withColumn("_chunk", F.spark_partition_id())
    if not freeze:
        return ranged
    checkpoint_dir(df.sparkSession)
    return ranged.checkpoint(eager=True)


def balanced_chunks(df: DataFrame, by, order, n_chunks: int | None = None) -> DataFrame:
    """The rows with a ``_chunk`` number that rises with (by, order), ties split too; checkpointed, so every read sees one assignment."""
    return _with_chunk(df, list(by), list(order), BALANCED, n_chunks, freeze=True)


def null_safe_left_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Left join on ``keys`` where NULL matches NULL (a window groups NULL
    keys together, so the carry must find them too)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[F.col(c) for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def chunked_sequence(df: DataFrame, by, order, values=(), chunk: str = DEFAULT_CHUNK,
                     with_seq: bool = True, prefix: str = "prev_", n_chunks: int | None = None) -> DataFrame:
    """One pass over (key, chunk) windows giving, per row, ``seq`` (1-based
    position within ``by`` in ``order``) and ``prev_<v>`` (previous row's
    value, carried across chunk borders).

    Plan: one shuffle on (by, chunk) + sort + window; the chunk summary is
    aggregated from that same window output (same partitioning, no new
    shuffle of rows), windowed per key on the small chunk table (prefix
    counts, last row of the previous chunk) and joined back on (by, chunk)."""
    by, order, values = list(by), list(order), list(values)
    d = _with_chunk(df, by, order, chunk, n_chunks, freeze=True)
    w = Window.partitionBy(*by, "_chunk").orderBy(*order)
    d = d.withColumn("_rn", F.row_number().over(w))
    for v in values:
        d = d.withColumn(f"_lag_{v}", F.lag(v).over(w))
    summary = [F.max("_rn").alias("_cnt")]
    if values:
        summary.append(F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                                      *[F.col(v).alias(v) for v in values])).alias("_last"))
    chunks = d.groupBy(*by, "_chunk").agg(*summary)
    cw = Window.partitionBy(*by).orderBy("_chunk") if by else Window.orderBy("_chunk")
    carry_cols = [F.coalesce(F.sum("_cnt").over(cw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")]
    if values:
        carry_cols.append(F.lag("_last").over(cw).alias("_carry"))
    carry = chunks.select(*by, "_chunk", *carry_cols)
    d = null_safe_left_join(d, carry, [*by, "_chunk"])
    first = F.col("_rn") == 1
    for v in values:
        d = d.withColumn(f"{prefix}{v}", F.when(first, F.col(f"_carry.{v}")).otherwise(F.col(f"_lag_{v}")))
    if with_seq:
        d = d.withColumn("seq", (F.col("_off") + F.col("_rn")).cast("long"))
    drop = ["_chunk", "_rn", "_off"] + (["_carry"] if values else []) + [f"_lag_{v}" for v in values]
    return d.drop(*drop)


def lag_across_chunks(df: DataFrame, by, order, values, chunk: str = DEFAULT_CHUNK,
                      prefix: str = "prev_", n_chunks: int | None = None) -> DataFrame:
    """Adds ``prev_<v>`` = value of the previous row per ``by`` in ``order``."""
    return chunked_sequence(df, by, order, values, chunk, with_seq=False, prefix=prefix, n_chunks=n_chunks)


def max_gap(df: DataFrame, by=(), ts: str = "transaction_timestamp", chunk: str = DEFAULT_CHUNK,
            tie: str | None = None, n_chunks: int | None = None) -> DataFrame:
    """Per ``by`` group: number of rows and the largest step between
    consecutive timestamps, in microseconds (NULL with < 2 rows).  Single
    lineage (no join back), so balanced chunks need no persisting."""
    by = list(by)
    order = [ts] + ([tie] if tie else [])
    d = _with_chunk(df.select(*by, *order), by, order, chunk, n_chunks)
    w = Window.partitionBy(*by, "_chunk").orderBy(*order)
    d = d.withColumn("_step", micros_between(F.lag(ts).over(w), F.col(ts)))
    chunks = d.groupBy(*by, "_chunk").agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"),
                                          F.max("_step").alias("_inner"), F.count(F.lit(1)).alias("_n"))
    cw = Window.partitionBy(*by).orderBy("_chunk") if by else Window.orderBy("_chunk")
    chunks = chunks.withColumn("_cross", micros_between(F.lag("_hi").over(cw), F.col("_lo")))
    return chunks.groupBy(*by).agg(F.sum("_n").alias("tick_count"),
                                   F.greatest(F.max("_inner"), F.max("_cross")).alias("max_gap_us"))


def sequenced(df: DataFrame, by, order, chunk: str = DEFAULT_CHUNK, name: str = "seq",
              n_chunks: int | None = None) -> DataFrame:
    """Adds ``seq`` = 1-based row position per ``by`` in ``order``."""
    out = chunked_sequence(df, by, order, (), chunk, with_seq=True, n_chunks=n_chunks)
    return out.withColumnRenamed("seq", name) if name != "seq" else out


def rolling_rows(df: DataFrame, by, seq: str, n: int, aggs: dict[str, Column],
                 block_rows: int = 100_000) -> DataFrame:
    """Aggregates over the frame of the last ``n`` rows (current included)
    per ``by``, ordered by the dense 1-based ``seq`` column."""
    if n < 1 or block_rows < n:
        raise ValueError("need 1 <= n <= block_rows")
    by = list(by)
    pos = F.col(seq) - 1
    home = F.floor(pos / block_rows)
    # every row lives in its own block; the last n-1 rows of a block are also
    # emitted into the next block as read-only context (one Generate, no union)
    in_tail = pos % block_rows >= block_rows - (n - 1)
    blocks = F.when(in_tail, F.array(home, home + 1)).otherwise(F.array(home))
    both = (df.select("*", F.posexplode(blocks).alias("_carry_idx", "_block"))
            .withColumn("_carry", F.col("_carry_idx") == 1).drop("_carry_idx"))
    w = Window.partitionBy(*by, "_block").orderBy(seq).rowsBetween(-(n - 1), 0)
    out = both.select("*", *[agg.over(w).alias(name) for name, agg in aggs.items()])
    return out.where(~F.col("_carry")).drop("_block", "_carry")
