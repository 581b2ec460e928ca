"""SimHash near-duplicates by multi-index hashing.

Fingerprint: A-Z are lower-cased, words are runs of anything but ASCII white
space, and every run of three words (fewer words: all of them) is hashed with
XXH64, seed 42.  A bit is set if it is set in over half the hashes.

Search: each distinct fingerprint is stored in two tables, by its upper and its
lower 32 bits.  Two fingerprints at three differing bits or fewer differ in at most one
bit of one half, so the Hamming ball of radius one around each half finds every
link: a fingerprint looks up its half and that half with one unset bit set (of
two halves one bit apart, exactly one has that bit unset).  Matches are verified
by the complete distance.  A half shared by more than ``hot`` fingerprints is not
joined pair by pair: there, fingerprints are grouped by their other half under
every mask of three (two, if one bit is spent) hidden bits; members of such a
group are within the distance, so each links to one of them and no link is lost.

Defined results: no words (null, empty or blank text) give fingerprint zero,
linked like any other; copies share one entry of the tables; repeated rows are
returned each; a null id takes part and a component's label is its smallest
non-null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import cut, give_back_memory, shared_folder, table
from candlewick.llm.components import connected_components

BITS, HALF = 3, 0xFFFFFFFF


def fingerprint_udf(words_in_shingle: int = 3):
    """Text to fingerprint, as a signed 64-bit number."""

    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from xxhash import xxh64_intdigest

        def of(text: str | None) -> int:
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()
            if not words:
                return 0
            n = max(1, len(words) - words_in_shingle + 1)
            set_bits = np.zeros(64, np.int64)
            for k in range(0, n, 20_000):
                parts = [words[k + j:min(n, k + 20_000) + j] for j in range(words_in_shingle)]
                shingles = map(b" ".join, zip(*parts, strict=True)) if len(words) >= words_in_shingle else [b" ".join(words)]
                hashes = np.array([xxh64_intdigest(s, 42) for s in shingles], "<u8")
                set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            return int(np.packbits(2 * set_bits > n, bitorder="little").view("<i8")[0])

        for texts in batches:
            yield pd.Series([of(text) for text in texts], dtype="int64")
            give_back_memory()

    return fingerprint


def _half(fp: str, upper: Column) -> Column:
    return F.when(upper, F.shiftrightunsigned(F.col(fp), 32)).otherwise(F.col(fp).bitwiseAND(F.lit(HALF)))


def near_links(prints: DataFrame, hot: int = 2048) -> DataFrame:
    """(a, b) links that join up all of the distinct ``fp`` at ``BITS`` or fewer differing bits."""
    # Dealt evenly first: a fingerprint is 8 bytes here and 33 probes later.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables = prints.repartition(parts, "fp").select("fp", F.explode(F.array(F.lit(True), F.lit(False))).alias("upper"))
    tables = tables.select("fp", "upper", _half("fp", F.col("upper")).alias("half"))
    ones = F.array(*[F.lit(1 << b).cast("long") for b in range(32)])
    ball = F.array_distinct(F.concat(F.array("half"), F.transform(ones, lambda one: F.col("half").bitwiseOR(one))))
    probes = tables.select("fp", "upper", "half", F.explode(ball).alias("at"))
    crowded = cut(tables.groupBy("upper", "half").count().where(F.col("count") > hot).select("upper", F.col("half").alias("at")))
    some = not crowded.isEmpty()
    quiet = probes.join(crowded, ["upper", "at"], "left_anti") if some else probes
    entries = tables.select(F.col("fp").alias("other"), "upper", F.col("half").alias("at"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= BITS
    once = (F.col("half") != F.col("at")) | (F.col("fp") < F.col("other"))
    links = quiet.join(entries, ["upper", "at"]).where(near & once).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    if some:
        links = links.unionByName(_crowded_links(probes.join(crowded, ["upper", "at"], "left_semi")))
    return links.distinct()


def _crowded_links(probes: DataFrame) -> DataFrame:
    """Links in crowded halves, by groups whose members agree outside a few hidden bits."""
    rows = probes.select("fp", "upper", "at", (F.col("half") == F.col("at")).alias("member"),
                         _half("fp", ~F.col("upper")).alias("rest"))
    two = (rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(30))))
           .withColumn("j", F.explode(F.expr("sequence(i + 1, 31)"))))
    three = (two.where("member and j < 31").withColumn("k", F.explode(F.expr("sequence(j + 1, 31)"))))
    groups = [f.withColumn("hidden", F.expr(hidden)).withColumn("seen", F.expr("rest & ~hidden"))
              for f, hidden in ((two, "shiftleft(1L, i) | shiftleft(1L, j)"),
                                (three, "shiftleft(1L, i) | shiftleft(1L, j) | shiftleft(1L, k)"))]
    keys, links = ["upper", "at", "hidden", "seen"], None
    for group in groups:
        centre = group.where("member").groupBy(*keys).agg(F.min("fp").alias("b"))
        found = group.select("fp", *keys).join(centre, keys).where("fp <> b").select(F.col("fp").alias("a"), "b")
        links = found if links is None else links.unionByName(found)
    return links.distinct()


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 3,
            hot: int = 2048) -> DataFrame:
    """(id, fp, component_id) per row; fp is the signed fingerprint."""
    own = cut(docs.select(F.col(id_col).alias("id"), fingerprint_udf(words_in_shingle)(F.col(text_col)).alias("fp")))
    prints = own.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(near_links(prints.select("fp"), hot))
    prints = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    labels = cut(prints.select("fp", "root", "least"))
    labels = cut(labels.select("fp", "root").join(labels.groupBy("root").agg(F.min("least").alias("component_id")), "root")
                 .select("fp", "component_id"))
    return own.join(labels, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 3) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns.

    The row with the smallest id stays (a null id comes last); of rows that share it, any one.
    """
    spark, path = docs.sparkSession, shared_folder(docs.sparkSession, "near-dedup-rows")
    docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                F.monotonically_increasing_id().alias("place")).write.parquet(path)  # the numbers must not change any more
    rows = spark.read.parquet(path)
    marked = rows.select(F.struct(F.col(f"row.{id_col}").isNull().alias("last"), F.col(f"row.{id_col}").alias("id"), "place").alias("key"),
                         F.col(f"row.{text_col}").alias("text"))
    best = cluster(marked, "key", "text", words_in_shingle).select("component_id.place").distinct()
    return rows.join(best, "place", "left_semi").select("row.*")
