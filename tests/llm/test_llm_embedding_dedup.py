import numpy as np

from candlewick.llm import embedding_dedup as E


def brute(vectors, threshold=0.9):
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in vectors]
    n = len(vectors)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                link[i, j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold
    label = np.arange(n)
    while True:
        new = np.array([min([label[i], *label[link[i]]]) for i in range(n)])
        if (new == label).all():
            return link.sum(1), label
        label = new


def test_links_and_components_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16)).astype(np.float32)
    near = [base[rng.integers(10)] + rng.normal(size=16) * rng.uniform(0.1, 0.5) for _ in range(160)]
    vectors = [list(map(float, v)) for v in [*base, *near, *base[:6], *base[:6], 3 * base[7]]]
    vectors += [None, [], [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [-0.0] * 15 + [1.0], [0.0] * 15 + [1.0]]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, n string")
    links, label = brute([None if v is None else [None if c is None else np.float32(c) for c in v] for v in vectors])
    for tile, room in ((2048, E.CELL_BYTES), (16, E.CELL_BYTES), (16, 3000)):
        monkeypatch.setattr(E, "CELL_BYTES", room)
        got = sorted(map(tuple, E.dedup_vectors(df, tile=tile).collect()))
        assert got == [(i, int(links[i]), int(label[i]), bool(label[i] == i)) for i in range(len(vectors))]


def test_bound_holds_for_every_pair():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 64)) * rng.lognormal(0, 2, (200, 64))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    q, scale, left_out = E.quantise(unit)
    length = np.linalg.norm(q.astype(float), axis=1) * scale
    off = np.abs(unit @ unit.T - (q.astype(float) @ q.T.astype(float)) * scale[:, None] * scale)
    assert (off <= left_out[:, None] + length[:, None] * left_out + 1e-12).all()


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01])], "vec_id long, embedding array<float>")
    assert [(r["n_links"], r["component_id"]) for r in E.dedup_vectors(df).collect()] == [(2, 1)] * 3
    assert E.dedup_vectors(df.limit(0)).count() == 0


def test_pairs_at_the_threshold(spark):
    """Cosines of whole-number vectors that are 0.9 exactly, just under and just over it; all are open after quantisation."""
    at = [[10.0, 0.0, 0.0, 0.0, 0.0], [9.0, 3.0, 3.0, 1.0, 0.0], [9.0, 3.0, 3.0, 1.0, 1e-3], [9.0, 3.0, 3.0, 0.999, 0.0], [-10.0, 0.0, 0.0, 0.0, 0.0]]
    df = spark.createDataFrame([(i, v, 5, "b") for i, v in enumerate(at)], "vec_id long, embedding array<double>, cls int, block string")
    links, label = brute(at)
    assert links[0] >= 2 and links[4] == 0
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in E.dedup_vectors(df).collect())
    assert got == [(i, int(links[i]), int(label[i])) for i in range(5)]


def test_a_dense_group_gives_rows_by_vector_not_by_pair(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=24)
    rows = [(i, list(map(float, base + rng.normal(size=24) * 0.33))) for i in range(600)]  # cosines around the threshold
    classes = spark.createDataFrame(rows, "cls long, x array<double>").selectExpr("cls", "x", "1L as n")
    assert E.link_classes(classes, tile=100).count() < 600 * 40
    links, label = brute([r[1] for r in rows])
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in E.dedup_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tile=100).collect())
    assert got == [(i, int(links[i]), int(label[i])) for i in range(600)]
