"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMO_LIMIT = 600_000
#: Longer words are not kept beyond their slice.
LONG_WORD = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, since executors share no local disk.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def held_out(id_col: Column, mod: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod == remainder


def worker_memo(name: str, limit: int = MEMO_LIMIT) -> dict:
    """A dictionary that outlives a task in its Python worker; found empty once it has passed ``limit`` entries."""
    holder = sys.modules.setdefault("_candlewick_worker_memo", types.ModuleType("_candlewick_worker_memo"))
    memo = holder.__dict__.setdefault(name, {})
    if len(memo) > limit:
        memo.clear()
    return memo


def text_slices(texts: pd.Series, limit: int = 4_000_000) -> Iterator[list[str]]:
    """The texts in order, nulls as empty, in lists of about ``limit`` characters (one text at least)."""
    own, size = [], 0
    for text in texts:
        text = text or ""
        if own and size + len(text) > limit:
            yield own
            own, size = [], 0
        own.append(text)
        size += len(text)
    if own:
        yield own


def map_codes(codes: np.ndarray, table: np.ndarray, of_code: Callable[[int], int]) -> np.ndarray:
    """``table`` for code points within it, ``of_code`` for each distinct one beyond it."""
    out = table[np.minimum(codes, len(table) - 1)]
    beyond = np.flatnonzero(codes >= len(table))
    if len(beyond):
        distinct, place = np.unique(codes[beyond], return_inverse=True)
        out[beyond] = np.array([of_code(int(c)) for c in distinct], table.dtype)[place]
    return out


def text_blocks(rows: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct (id, text) rows in blocks of about ``block_chars`` characters; rows without a text are left out.

    For a query set that is set against all rows, block by block; a null id stays null.
    """
    items = cut(rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null").distinct())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars)
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        if own:
            yield sorted(((r["id"], r["text"]) for r in own), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def give_back_memory() -> None:
    """Return freed memory to the system: Python workers outlive their tasks beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def vocabulary_path(file_name: str) -> str:
    """Path of a public tokenizer file; ``TOKENIZER_DIR`` overrides the installed package."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, file_name)
    import public_tokenizers
    return public_tokenizers.path(file_name)
