"""Models against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators import features, matrix, models, neighbours, signal, stats


def _frame(spark, ids, xs, ys):
    return spark.createDataFrame([(int(i), [float(v) for v in x], int(y)) for i, x, y in zip(ids, xs, ys)], "id long, x array<double>, y int")


@pytest.mark.parametrize("metric", ["euclid", "manhattan"])
@pytest.mark.parametrize("leaf,fan,block", [(4_096, 64, 20_000), (60, 8, 25), (7, 3, 20_000)])
def test_neighbours_equal_brute_force(spark, metric, leaf, fan, block):
    rng = np.random.default_rng(4)
    train = np.vstack([rng.normal(0, 0.01, (120, 3)), rng.normal(0, 5, (150, 3)), np.zeros((30, 3))])
    queries = np.vstack([rng.normal(0, 5, (20, 3)), np.zeros((10, 3)), rng.normal(0, 0.01, (25, 3))])
    labels = rng.integers(0, 3, len(train))
    got = neighbours.neighbours(_frame(spark, range(len(train)), train, labels), _frame(spark, range(len(queries)), queries, [0] * len(queries)),
                            "x", "y", "id", 5, metric, leaf, fan, block).collect()
    found = {}
    for r in got:
        found.setdefault(r["id"], {})[r["rank"]] = (r["neighbour"], r["distance"])
    for i, q in enumerate(queries):
        gap = train - q
        d = np.sqrt((gap ** 2).sum(axis=1)) if metric == "euclid" else np.abs(gap).sum(axis=1)
        order = np.lexsort((np.arange(len(d)), d))[:5]
        assert [found[i][k + 1][0] for k in range(5)] == list(order)


@pytest.mark.parametrize("scale", [1.0, 1e-42, 1e36, 1e-10])
def test_manhattan_neighbours_are_exact_where_single_precision_is_not(scale):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(1, 64))
    b = (base + rng.integers(0, 3, (700, 64)) * 1e-9) * scale  # nearly equal rows: gaps far below 2^-24 of the values
    b[:300] = rng.normal(size=(300, 64)) * scale
    a = np.vstack([b[290:310], base * scale])
    at, to, far = neighbours.nearest_in(a, b, np.arange(len(b)), 7, "manhattan")
    for i, q in enumerate(a):
        d = np.abs(b - q).sum(axis=1)
        order = np.lexsort((np.arange(len(d)), d))[:7]
        assert list(to[at == i]) == list(order) and (far[at == i] == d[order]).all()
    d, off = neighbours.distances(a, b, "manhattan")
    assert (np.abs(d - np.abs(a[:, None] - b[None]).sum(axis=2)) <= off[:, None]).all()


@pytest.mark.parametrize("metric", ["euclid", "manhattan"])
def test_equal_rows_are_compared_in_bounded_memory(metric):
    import tracemalloc

    b = np.tile(np.random.default_rng(1).normal(size=(2, 64)), (5_000, 1))
    a, ids = b[:60], np.arange(len(b))[::-1].copy()
    tracemalloc.start()
    at, to, far = neighbours.nearest_in(a, b, ids, 3, metric)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6  # 250,000 pairs of equal rows at a time would take 128 MB for each side
    assert (far == 0).all() and [sorted(ids[to[at == i]]) for i in range(60)] == [[(i + 1) % 2, (i + 1) % 2 + 2, (i + 1) % 2 + 4] for i in range(60)]


def test_comparisons_are_dealt_by_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "WORK", 500)
    x = np.random.default_rng(2).normal(size=(300, 2))
    rows, asked = (_frame(spark, ids, x[ids], [0] * len(ids)).withColumn("cell", F.lit(0).cast("long")) for ids in (np.arange(300), np.arange(0, 300, 4)))
    found = neighbours._found(asked, rows, "manhattan", 3, 25, "int")
    tasks = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 3 and found.select("id").distinct().count() == 75


@pytest.mark.parametrize("kind", ["float", "double"])
def test_queries_are_not_copied_to_cells_that_all_have_to_be_read(spark, kind):
    """Directions at random in 32 dimensions: no cell can be left out, so a query is one row, not one for each cell."""
    x = np.random.default_rng(8).normal(size=(1_500, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = spark.createDataFrame(pd.DataFrame({"id": np.arange(1_500), "y": np.arange(1_500) % 7, "x": list(x)}), f"id long, y int, x array<{kind}>")
    asked = rows.filter("id % 10 = 0")
    rows = rows.filter("id % 10 <> 0")
    placed, cells = neighbours.visits(rows, asked.select("id", "x"), 5, "euclid", 128, 16, 400)
    assert cells.select("cell").distinct().count() > 10 and cells.count() == 1_350
    assert placed.count() <= 3 * 150 and placed.select("id").distinct().count() == 150
    assert placed.schema["x"].dataType == cells.schema["x"].dataType == rows.schema["x"].dataType
    whole = neighbours.under(placed, cells).groupBy("cell").count()
    assert placed.join(whole, "cell").groupBy("id").agg(F.sum("count").alias("n")).filter("n >= 5").count() == 150
    got = neighbours.neighbours(rows, asked, "x", "y", "id", 5, "euclid", 128, 16, 400).collect()
    found = {(r["id"], r["rank"]): (r["neighbour"], r["y"]) for r in got}
    others, x = np.flatnonzero(np.arange(1_500) % 10), x.astype(float)
    for i in range(0, 1_500, 10):
        near = others[np.argsort(np.sqrt(((x[others] - x[i]) ** 2).sum(axis=1)), kind="stable")[:5]]
        assert [found[i, k + 1] for k in range(5)] == [(j, j % 7) for j in near]


def test_queries_that_leave_some_children_out_go_on_down(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (5_000, 2)), rng.normal(0, 500, (500, 2))])
    rows = spark.createDataFrame(pd.DataFrame({"id": np.arange(5_500), "y": 0, "x": list(x)}), "id long, y int, x array<double>")
    compared = []
    for share in (neighbours.WHOLE, 2.0):
        monkeypatch.setattr(neighbours, "WHOLE", share)
        placed, cells = neighbours.visits(rows, rows.filter("id < 5000 and id % 50 = 0").select("id", "x"), 5, "euclid", 128, 16, 2_000)
        compared.append(placed.join(neighbours.under(placed, cells).groupBy("cell").count(), "cell").agg(F.sum("count")).head()[0])
    assert compared[0] < 1.5 * compared[1]


def test_queries_visit_few_rows_of_a_clustered_table(spark):
    """Rows compared per query grow far slower than the table."""
    rng = np.random.default_rng(6)
    shares = []
    for n in (4_000, 16_000):
        centers = rng.normal(0, 50, (n // 100, 4))
        x = centers[rng.integers(0, len(centers), n)] + rng.normal(0, 1, (n, 4))
        rows = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "y": 0, "x": list(x)}), "id long, y int, x array<double>")
        q = rows.filter("id % 80 = 0").select("id", "x")
        placed, cells = neighbours.visits(rows, q, 5, "euclid", 128, 16, 2_000)
        sizes = cells.groupBy("cell").count()
        compared = placed.join(sizes, "cell").agg(F.sum("count")).head()[0]
        shares.append(compared / q.count() / n)
        assert cells.count() == n
    assert shares[0] < 0.15 and shares[1] < 0.5 * shares[0]


@pytest.mark.parametrize("block", [4, 7, 512])
def test_block_products_equal_numpy(spark, block):
    """Dense, sparse and tall factors, negative and far-off indexes, repeated cells and nulls."""
    rng = np.random.default_rng(block)
    for shape, share in (((19, 23, 11), 1.0), ((30, 40, 30), 0.1), ((3, 90, 3), 0.7)):
        a = rng.integers(-4, 5, shape[:2]) * (rng.random(shape[:2]) < share)
        b = rng.integers(-4, 5, shape[1:]) * (rng.random(shape[1:]) < share)
        cells = lambda m, i0, j0: [(int(i) - i0, int(j) - j0, float(m[i, j])) for i, j in np.argwhere(m)]
        left = cells(a, 9, 5) + [(1, None, 2.0), (None, 1, 2.0), (2, 2, None)]
        left += [(i, j, 1.0) for i, j, _ in left[:3]] + [(i, j, -1.0) for i, j, _ in left[:3]]
        right = cells(b, 5, -10**9)
        got = matrix.matmul(*(spark.createDataFrame(x, "i long, j long, v double") for x in (left, right)), block=block).collect()
        want = a @ b
        met = (a != 0).astype(int) @ (b != 0).astype(int)
        assert {(r["i"] + 9, r["j"] - 10**9): r["v"] for r in got} == {(i, j): float(want[i, j]) for i, j in np.argwhere(met).tolist()}
    empty = spark.createDataFrame([], "i long, j long, v double")
    assert matrix.matmul(empty, empty, block).count() == 0


def test_products_over_one_inner_stretch_are_not_shuffled(spark):
    """Rows of the result are many times the input's; only blocks of the factors travel, to tasks by their products."""
    rng = np.random.default_rng(8)
    x, full = rng.integers(1, 9, (130, 3)), rng.random((130, 3)) < 0.6
    full[:65] = True  # some blocks are filled, some are not
    long = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in np.argwhere(full)], "i long, j long, v double")
    got = matrix.matmul(long, matrix.transpose(long), block=16)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("FlatMapCoGroupsInArrow")[0]
    cells = got.select("i", "j", "v", F.spark_partition_id().alias("p")).toPandas()
    met = full.astype(int) @ full.T.astype(int)
    want = (x * full) @ (x * full).T
    assert len(cells) == (met > 0).sum() and (cells["v"] == want[cells["i"], cells["j"]]).all()
    assert cells.groupby("p").size().max() < len(cells) / 3
    assert matrix.matmul(matrix.transpose(long), long, block=16).count() == 9


def test_blocks_are_copied_for_groups_of_products(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.integers(1, 9, (256, 3))
    long = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(256) for j in range(3)], "i long, j long, v double")
    one, two, tasks, final = matrix._dealt(long, matrix.transpose(long), 4)
    assert final and tasks == 256
    assert one.count() == two.count() == 16 * x.size  # of 64 blocks that each one meets
    got = matrix.matmul(long, matrix.transpose(long), block=4).toPandas()
    assert len(got) == 256 * 256 and (got["v"] == (x @ x.T)[got["i"], got["j"]]).all()
    monkeypatch.setattr(matrix, "CELLS", 24)  # no more than two blocks of 4 x 3 cells to a side
    assert matrix._dealt(long, matrix.transpose(long), 4)[0].count() == 32 * x.size


def test_no_neighbour_without_rows(spark):
    none = _frame(spark, [], [], [])
    assert neighbours.neighbours(none, none, "x", "y", "id", 3).count() == 0


def test_fewer_training_rows_than_k(spark):
    train = _frame(spark, [1, 2], [[0, 0], [1, 1]], [0, 1])
    got = models.knn(train, _frame(spark, [9], [[0, 0.1]], [0]), "x", "y", "id", 15).collect()
    assert [(r["id"], r["predicted"]) for r in got] == [(9, 0)]


def test_pca_equals_svd(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6)) + 3
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    fit = signal.pca_fit(df, "x", 4)
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    for mine, want in zip(fit.loadings, vt[:4]):
        want = want if want[np.abs(want).argmax()] > 0 else -want
        assert np.allclose(mine, want, atol=1e-6)
    assert np.allclose(fit.explained, (s ** 2 / (s ** 2).sum())[:4])
    scored = signal.pca_transform(df, "x", fit)
    back = signal.pca_inverse(scored, "scores", fit).orderBy("id").collect()
    loadings = np.array(fit.loadings)
    want = centred @ loadings.T @ loadings + x.mean(axis=0)
    assert np.allclose([r["restored"] for r in back], want)
    curve = {r["k"]: r for r in signal.pca_curve(df, "x", fit, [2, 4]).collect()}
    assert curve[4]["mse"] == pytest.approx(((x - want) ** 2).mean())
    assert curve[2]["compression"] == 3
    assert signal.choose_k(fit, 0.0001) == 1 and signal.choose_k(fit, 2) == 4


def test_chunks_round_trip(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(23)], "i int, v double")
    c = signal.chunk(df, ["i"], "v", 5)
    last = c.filter("chunk_id = 4").first()["samples"]
    assert last == [20.0, 21.0, 22.0, 0.0, 0.0]
    back = signal.unchunk(c, 5, 23).orderBy("pos").collect()
    assert [r["v"] for r in back] == [float(i) for i in range(23)]


def _lines(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=300)
    return x, spark.createDataFrame([(float(a), float(2 * a + 1)) for a in x], "x double, y double")


def test_gradient_descent_path(spark):
    x, df = _lines(spark)
    path = [r["weights"] for r in models.fit_gd(df, ["x"], "y", n_iter=300).orderBy("step").collect()]
    design = np.column_stack([np.ones_like(x), x])
    w, lr = np.zeros(2), 1.0
    for step in path[1:50]:
        g = 2 * design.T @ (design @ w - (2 * x + 1)) / len(x)
        w = w - lr * g / np.linalg.norm(g)
        lr = max(lr - 0.001, 0.001)
        assert np.allclose(step, w)


def test_rmsprop_reaches_the_line(spark):
    _, df = _lines(spark)
    last = models.fit_rmsprop(df, ["x"], "y", lr=0.3, n_iter=400).orderBy("step").collect()[-1]["weights"]
    assert last == pytest.approx([1, 2], abs=0.2)


def test_standardise_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0), (5.0, 4.0)], "a double, b double")
    got = features.standardise(df, ["a", "b"], 2).orderBy("a").collect()
    assert [tuple(r) for r in got] == [(-1.22, 0.0), (0.0, 0.0), (1.22, 0.0)]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    got = {(r["a"], r["b"]): r["r"] for r in stats.corr_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("a", "a")] == pytest.approx(1)


def test_cut_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.99,), (1.0,), (99.0,), (None,)], "v double")
    got = [r[0] for r in df.select(features.cut(df["v"], [0.0, 1.0, float("inf")], ["a", "b"])).collect()]
    assert got == [None, "a", "a", "b", "b", None]


def test_matrices(spark):
    a = np.array([[1.0, 2.0], [0.0, 3.0], [4.0, 0.0]])
    long = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(3) for j in range(2)], "i int, j int, v double")
    got = {(r["i"], r["j"]): r["v"] for r in matrix.matmul(long, matrix.transpose(long)).collect()}
    want = a @ a.T
    assert all(got[i, j] == want[i, j] for i in range(3) for j in range(3))
    tri = spark.createDataFrame([(0, 0, 2.0), (1, 0, 5.0), (1, 1, 4.0), (2, 2, -4.0)], "i int, j int, v double")
    assert matrix.symmetrise(tri).count() == 5
    assert matrix.diag_product(tri).first()["product"] == 8


def test_association_of_equal_and_independent_columns(spark):
    df = spark.createDataFrame([(str(i % 2), str(i % 2), str(i // 2 % 2)) for i in range(40)], "a string, b string, c string")
    got = {(r["a"], r["b"]): r["cramers_v"] for r in stats.association_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1) and got[("a", "c")] == pytest.approx(0)
