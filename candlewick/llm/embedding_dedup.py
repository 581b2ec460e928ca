"""Embedding near-duplicates by int8 tile products with per-vector error bounds.

Equal vectors become one class first.  Classes are dealt to blocks of about
``tile`` vectors near one of a number of pivots that grows with the table, and a block is one row:
its vectors in int8 with a scale each and the exact length of what quantisation left
out.  Two blocks are compared only if the angle
between their centres, less both radii, allows the threshold (the triangle
inequality on the sphere, so nothing is lost).  Blocks are dealt to groups, and a pair of groups is a
cell: a block goes once to each cell that compares it, not to each of its partners.

Within a tile the int8 products
give every cosine to within a proven bound.  Only tiles in which some cosine may lie on
either side of the threshold are done again: then the vectors concerned, and no others, come along in
full, and only pairs that are undecided are computed from them in double precision.

A tile gives each vector's number of links, weighted by class size, and one edge
from each linked vector to the first of its group in the tile.  So the output of a
tile is no larger than its vectors, however many pairs link.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different dimension do not link; rows
with equal vectors link with each other; repeated rows are vectors of their own; a pair at the threshold links;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import cut, table
from candlewick.llm.components import connected_components

THRESHOLD, TILE, PIVOTS, GRID = 0.9, 2048, 1024, 512
#: Bytes of blocks on one side of a cell.
CELL_BYTES = 16_000_000
_BLOCK = "block long, cls binary, n binary, dim int, q binary, scale binary, left_out binary, centre array<double>, radius double"


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, scales, and upper bounds of the length of what each vector loses."""
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    left_out = np.linalg.norm(unit - q * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return q, scale, left_out


def _pack(block: pd.DataFrame) -> pd.DataFrame:
    """One row for the vectors of a block."""
    x = np.stack(block["x"].to_numpy()).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    q, scale, left_out = quantise(unit)
    centre = unit.mean(0)
    centre = centre / np.linalg.norm(centre) if np.linalg.norm(centre) > 1e-9 else unit[0]
    radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
    return pd.DataFrame({"block": [block["block"].iloc[0]], "cls": [block["cls"].to_numpy(np.int64).tobytes()],
                         "n": [block["n"].to_numpy(np.int64).tobytes()], "dim": [x.shape[1]],
                         "q": [q.tobytes()], "scale": [scale.tobytes()], "left_out": [left_out.tobytes()],
                         "centre": [centre.tolist()], "radius": [radius]})


def decided(a: dict, b: dict, threshold: float, slack: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of two blocks surely link, and which may: boolean matrices without a pair in common."""
    # Products of int8 vectors of under 1,000 dimensions are whole numbers that float32 holds exactly.
    wide = np.float32 if a["q"].shape[1] < 1000 else np.float64
    near = (a["q"].astype(wide) @ b["q"].astype(wide).T).astype(np.float64) * a["scale"][:, None] * b["scale"]
    length = np.linalg.norm(a["q"].astype(np.float64), axis=1) * a["scale"]
    bound = a["left_out"][:, None] + length[:, None] * b["left_out"] + slack
    link = near - bound >= threshold
    return link, ~link & (near + bound >= threshold)


def settle(link: np.ndarray, open_pairs: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float) -> None:
    """Decide the open pairs from the vectors in full; ``x`` and ``y`` have a row for each that has an open pair."""
    norm_x, norm_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    i, j = np.nonzero(open_pairs)
    for k in range(0, len(i), 100_000):
        r, c = i[k:k + 100_000], j[k:k + 100_000]
        link[r, c] = np.einsum("ij,ij->i", x[r], y[c]) / (norm_x[r] * norm_y[c]) >= threshold


def _groups(link: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first row, linked vector) for each group of a tile; columns are numbered after the rows."""
    rows, cols = link.shape
    row_left, col_left = link.any(1), link.any(0)
    for first in np.flatnonzero(row_left):
        if not row_left[first]:
            continue
        row_left[first], frontier = False, np.array([first])
        while len(frontier):
            new = np.flatnonzero(link[frontier].any(0) & col_left)
            col_left[new] = False
            yield from ((first, rows + c) for c in new)
            frontier = np.flatnonzero(link[:, new].any(1) & row_left) if len(new) else new
            row_left[frontier] = False
            yield from ((first, r) for r in frontier)


_CELL = "cell long, cls long, links long, first long, block_a long, block_b long"


def _cell(blocks: pd.DataFrame, pairs: pd.DataFrame, threshold: float, wide: dict[int, np.ndarray] | None) -> Iterator[pd.DataFrame]:
    """All tiles of a cell.  Rows are links and group edges; of a tile with open pairs, if vectors in full
    are not at hand, the vectors that these pairs need, with the tile's blocks."""
    held = {}
    for p in blocks.to_dict("records"):
        own = {k: np.frombuffer(p[k], t) for k, t in (("cls", np.int64), ("n", np.int64), ("q", np.int8), ("scale", np.float64), ("left_out", np.float64))}
        held[p["block"]] = own | {"q": own["q"].reshape(-1, int(p["dim"]))}
    for block_a, block_b in zip(pairs["block_a"], pairs["block_b"], strict=True):
        a, b, same = held[block_a], held[block_b], block_a == block_b
        link, open_pairs = decided(a, b, threshold)
        if same:
            np.fill_diagonal(link, False)
            np.fill_diagonal(open_pairs, False)
        if open_pairs.any():
            rows, cols = np.flatnonzero(open_pairs.any(1)), np.flatnonzero(open_pairs.any(0))
            if wide is None:
                need = np.unique(np.concatenate([a["cls"][rows], b["cls"][cols]]))
                yield pd.DataFrame({"cls": need, "links": 0, "first": -1, "block_a": block_a, "block_b": block_b})
                continue
            full = [np.zeros((len(side["cls"]), side["q"].shape[1])) for side in (a, b)]
            for to, side, which in ((full[0], a, rows), (full[1], b, cols)):
                for i in which:
                    to[i] = wide[int(side["cls"][i])]
            settle(link, open_pairs, *full, threshold)
        if not link.any():
            continue
        first = np.arange(len(a["cls"]) + len(b["cls"]))
        for root, node in _groups(link):
            first[node] = root
        of = np.concatenate([a["cls"], b["cls"]])
        # Within one block the rows carry the counts; the columns only take part in the groups.
        count = np.concatenate([link @ b["n"], np.zeros(len(of) - len(a["n"]), np.int64) if same else a["n"] @ link])
        has = np.concatenate([link.any(1), link.any(0)])
        yield pd.DataFrame({"cls": of[has], "links": count[has], "first": of[first[has]], "block_a": block_a, "block_b": block_b})


def _cells(data: DataFrame, pairs: DataFrame, threshold: float, wide: DataFrame | None = None) -> DataFrame:
    """The rows of all cells, from (cell, block, ...) rows, (cell, block_a, block_b) rows and, if given, (cell, cls, x) rows."""
    columns, given = data.columns, wide is not None
    if wide is not None:
        data = data.withColumn("x", F.lit(None).cast("array<double>")).unionByName(
            wide.select("cell", "x", F.col("cls").alias("block")), allowMissingColumns=True)

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        full = None
        if given:
            own = left[left["x"].notna()]
            full = dict(zip(own["block"].tolist(), map(np.asarray, own["x"]), strict=True))
            left = left[left["x"].isna()][columns]
        parts = list(_cell(left, right, threshold, full))
        out = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({c: np.empty(0, np.int64) for c in ("cls", "links", "first", "block_a", "block_b")})
        return out.assign(cell=key[0])[["cell", "cls", "links", "first", "block_a", "block_b"]]

    pairs = pairs.select(F.col("cell").alias("pair_cell"), "block_a", "block_b")
    return data.groupBy("cell").cogroup(pairs.groupBy("pair_cell")).applyInPandas(run, _CELL)


def link_classes(classes: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, pivots: int = PIVOTS) -> DataFrame:
    """(cls, links, first) rows from all tiles over (cls, x, n): partial link counts and group edges."""
    spark = classes.sparkSession
    if classes.isEmpty():
        return spark.createDataFrame([], "cls long, links long, first long")
    # Pivots only decide which vectors sit together, so a bounded sample by hash is enough; one for each block, up to a bound.
    total, size = classes.agg(F.count("*"), F.max(F.size("x"))).first()
    pivots = max(1, min(pivots, total // tile))
    centres = [np.array(r["x"], float) for r in classes.orderBy(F.xxhash64("cls")).limit(pivots).select("x").collect()]
    centres = [c / np.linalg.norm(c) for c in centres]

    @F.pandas_udf("int")
    def cell(x: pd.Series) -> pd.Series:
        def of(v: np.ndarray) -> int:
            alike = [(float(c @ v), -k) for k, c in enumerate(centres) if len(c) == len(v)]
            return -max(alike)[1] if alike else -1
        return pd.Series([of(np.asarray(v, float)) for v in x], dtype="int32")

    placed = cut(classes.withColumn("dim", F.size("x")).withColumn("cell", cell("x")))
    cells = (placed.groupBy("dim", "cell").count().withColumn("parts", F.ceil(F.col("count") / tile))
             .select(F.col("dim").alias("d"), F.col("cell").alias("c"), "parts"))
    placed = placed.join(cells, (F.col("dim") == F.col("d")) & (F.col("cell") == F.col("c")))
    part = F.pmod(F.xxhash64("cls"), F.col("parts"))
    placed = placed.select("cls", "x", "n", F.xxhash64("dim", "cell", part).alias("block"))
    blocks = cut(placed.groupBy("block").applyInPandas(_pack, _BLOCK))
    # Every unordered pair of blocks once, if their centres allow a link.  Blocks are dealt to groups of about
    # GRID, and each pair of groups is a join key of its own.
    groups = -(-blocks.count() // GRID)
    known = blocks.select("block", "dim", "centre", "radius", F.pmod(F.xxhash64(F.lit("grid"), "block"), F.lit(groups).cast("long")).alias("g"))
    ahead = known.select("*", F.explode(F.sequence("g", F.lit(groups - 1).cast("long"))).alias("h"))
    behind = known.select(F.struct("block", "centre", "radius").alias("o"), "dim", F.col("g").alias("h"),
                          F.explode(F.sequence(F.lit(0).cast("long"), "g")).alias("g"))
    pairs = ahead.join(behind, ["dim", "g", "h"]).where("g < h or block <= o.block")
    cos = F.aggregate(F.zip_with("centre", "o.centre", lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos))) - F.col("radius") - F.col("o.radius")
    pairs = pairs.where(apart <= float(np.arccos(threshold)) + 1e-6).select(F.col("block").alias("block_a"), F.col("o.block").alias("block_b"))
    # Blocks of about CELL_BYTES make a group; a cell is a pair of groups.
    deal = max(1, -(-blocks.count() * tile * (size + 48) // CELL_BYTES))
    group = lambda c: F.pmod(F.xxhash64(F.lit("cell"), c), F.lit(deal).cast("long"))
    pairs = pairs.select(F.least(group("block_a"), group("block_b")).alias("u"), F.greatest(group("block_a"), group("block_b")).alias("v"), "block_a", "block_b")
    pairs = cut(pairs.select((F.col("u") * F.lit(deal).cast("long") + F.col("v")).alias("cell"), "block_a", "block_b"))
    data = blocks.select("block", "cls", "n", "dim", "q", "scale", "left_out")

    def used(which: DataFrame) -> DataFrame:
        """Each block once for each cell that compares it."""
        own = which.select("cell", F.explode(F.array("block_a", "block_b")).alias("block")).distinct()
        return own.join(data, "block").select("cell", *data.columns)

    found = cut(_cells(used(pairs), pairs, threshold))
    out, needs = found.where("first >= 0"), found.where("first < 0")
    if not needs.isEmpty():
        again = cut(needs.select("cell", "block_a", "block_b").distinct())
        wide = needs.select("cell", "cls").distinct().join(classes.select("cls", "x"), "cls")
        out = out.unionByName(_cells(used(again), again, threshold, wide))
    return out.select("cls", "links", "first")


def dedup_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                  tile: int = TILE) -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    x = F.col(vector_col).cast("array<double>")
    whole = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(whole, x).alias("x"))
    classes = cut(rows.where("x is not null").groupBy("x").agg(F.min("id").alias("least"), F.count("*").alias("n"))
                  .withColumn("cls", F.monotonically_increasing_id()))
    found = cut(link_classes(classes.select("cls", "x", "n"), threshold, tile))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("cls").alias("a"), F.col("first").alias("b")))
    told = (classes.join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
            .select("x", "cls", "least", F.coalesce("root", "cls").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    told = cut(told)
    named = told.groupBy("root").agg(F.min("least").alias("component_id"))
    told = cut(told.join(named, "root").select(F.col("x").alias("_x"), "n_links", "component_id"))
    out = rows.join(told, F.col("x") == F.col("_x"), "left")
    component = F.when(F.col("_x").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_vectors(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
e AS (SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.9),
r(i, j) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.i, e.j FROM r JOIN e ON r.j = e.i),
c AS (SELECT i AS vec_id, min(j) AS component_id FROM r GROUP BY i)
SELECT c.vec_id, CAST((SELECT count(*) FROM e WHERE e.i = c.vec_id) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept FROM c
"""
