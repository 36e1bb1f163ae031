"""Exact nearest neighbours through a metric tree.

Training rows are cut into cells around sampled pivots, level by level, until a cell has a few thousand rows; so
the number of pivots and of levels grows with the table. Queries first go down to the cell nearest to them, and the k
distances found there bound what a neighbour can be. With this bound they go down again into every child that
can hold a nearer row by the triangle inequality. Where that leaves out less than a quarter of a cell's children and rows, a query stays
and meets the cell as a whole, so it isn't copied to cells that all have to be read. Rows and queries meet as blocks,
compared by one matrix product; distances that count are computed anew from the differences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidewater.staging import stage

#: Rows of a cell that isn't cut, pivots of one that is, rows of a block, and the depth at which cutting ends.
LEAF, FAN, BLOCK, DEPTH = 4_096, 64, 20_000, 5
#: Queries of a block that goes down, each to many children maybe; rows of one task; and the share of a cell from which it is compared as a whole.
ASKING, ROWS, WHOLE = 2_000, 50_000, 0.75
#: Child cells are numbered parent * WIDTH + 1, 2, ...
WIDTH = 4_096
#: Pairs that one numpy step compares, that stay in the processor's cache, and that one task compares, up to so many tasks.
_PAIRS, _TILE, WORK, TASKS = 500_000, 65_536, 100_000_000, 4_000
#: Numbers of each side that are compared exactly at a time.
_EXACT = 1_000_000


def matrix(table: pa.Table) -> np.ndarray:
    """The column x as one block of doubles."""
    if not table.num_rows:
        return np.zeros((0, 0))
    flat = np.concatenate([np.asarray(c.flatten(), float) for c in table["x"].chunks])
    return flat.reshape(table.num_rows, -1)


def exact_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of paired rows."""
    gap = a - b
    return np.sqrt((gap * gap).sum(axis=1)) if metric == "euclid" else np.abs(gap).sum(axis=1)


def paired_distances(a: np.ndarray, row: np.ndarray, b: np.ndarray, col: np.ndarray, metric: str) -> np.ndarray:
    """Distances of row[i] of a and col[i] of b; the rows are copied a stretch at a time, for there may be as many pairs as there are equal rows."""
    out = np.empty(len(row))
    for i in range(0, len(row), step := max(1, _EXACT // max(1, a.shape[1]))):
        out[i : i + step] = exact_distances(a[row[i : i + step]], b[col[i : i + step]], metric)
    return out


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """All distances between two blocks, and how far each row's may be off by rounding."""
    if metric == "euclid":
        aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
        square = np.maximum(aa[:, None] + bb[None, :] - 2.0 * (a @ b.T), 0.0)
        return np.sqrt(square), np.sqrt(1e-12 * (aa + (bb.max() if len(bb) else 0.0)))
    return _manhattan(a, b)


def _manhattan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One dimension at a time over a tile of rows, in single precision where the numbers allow it.

    Each of d terms and sums is off by at most 2^-24 of the two rows' norms; twice that is given, and what lies within is compared exactly.
    """
    na, nb = np.abs(a).sum(axis=1), np.abs(b).sum(axis=1)
    top = max(na.max(initial=0.0), nb.max(initial=0.0))
    kind, unit = (np.float32, 2.0**-23) if 1e-20 < top < 1e30 else (np.float64, 2.0**-52)  # not with NaN either
    x, y = a.astype(kind), np.ascontiguousarray(b.T, kind)
    out = np.zeros((len(a), len(b)), kind)
    step = max(1, _TILE // max(1, len(b)))
    room = np.empty((step, len(b)), kind)
    for i in range(0, len(a), step):
        part, tile = x[i : i + step], out[i : i + step]
        gap = room[: len(part)]
        for j in range(a.shape[1]):
            np.subtract(part[:, j, None], y[j], out=gap)
            np.abs(gap, out=gap)
            tile += gap
    return out, unit * ((a.shape[1] + 4) * (na + nb.max(initial=0.0)) + 1e-30)


def nearest_in(a: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance) of the k nearest rows of b, ties to the smaller id, for every row of a."""
    at, to, far = [], [], []
    keep, step = min(k, len(b)), max(1, _PAIRS // max(1, len(b)))
    for i in range(0, len(a) if keep else 0, step):
        part = a[i : i + step]
        d, off = distances(part, b, metric)
        limit = np.partition(d, keep - 1, axis=1)[:, keep - 1] + 2 * off
        row, col = np.nonzero(d <= limit[:, None])
        exact = paired_distances(part, row, b, col, metric)
        order = np.lexsort((ids[col], exact, row))
        row, col, exact = row[order], col[order], exact[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < keep
        at.append(row[best] + i)
        to.append(col[best])
        far.append(exact[best])
    none = np.zeros(0, int)
    return (np.concatenate(at), np.concatenate(to), np.concatenate(far)) if at else (none, none, np.zeros(0))


def _meet(left: DataFrame, right: DataFrame, work, schema: str, block: int, salt: Column, rows: int | None = None) -> DataFrame:
    """`work` on every pair of blocks of the two sides of a cell; cells of any size are spread over many tasks. Blocks have up to about `block` rows, those of the left side `rows` if given."""
    count = F.count(F.lit(1))
    cuts = left.groupBy("cell").agg(F.ceil(count / (rows or block)).cast("int").alias("ls"), count.alias("ln")).join(
        right.groupBy("cell").agg(F.ceil(count / block).cast("int").alias("rs"), count.alias("rn")), "cell")
    cuts = stage(cuts.select("cell", "ls", "rs", (F.col("ln").cast("double") * F.col("rn")).alias("pairs"), (F.col("ln") * F.col("rs") + F.col("rn") * F.col("ls")).alias("copies")))
    # Tasks by the pairs to compare, of which the rows' bytes say little, and by the rows where these are many.
    size = cuts.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    tasks = min(TASKS, max(int(size[0] // WORK), size[1] // ROWS) + 1)
    cuts = cuts.drop("pairs", "copies")
    one = left.join(cuts, "cell").withColumn("lb", F.pmod(F.xxhash64("id"), F.col("ls")).cast("int")).withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("rs") - 1))).drop("ls", "rs")
    two = right.join(cuts, "cell").withColumn("rb", F.pmod(salt, F.col("rs")).cast("int")).withColumn("lb", F.explode(F.sequence(F.lit(0), F.col("ls") - 1))).drop("ls", "rs")
    one, two = (d.repartition(tasks, "cell", "lb", "rb").groupBy("cell", "lb", "rb") for d in (one, two))
    return one.cogroup(two).applyInArrow(work, schema)


def _split(rows: DataFrame, level: int, metric: str, leaf: int, fan: int, block: int, label: str) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(rows that stay, rows in their child cells, the children) of a level; None when no cell is to be cut."""
    kind = rows.schema["x"].dataType.simpleString()
    big = stage(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("id", "x")).alias("least")).filter(F.col("size") > leaf))
    if big.isEmpty():
        return None
    resting, cut = rows.join(big, "cell", "left_anti"), rows.join(big.select("cell", "size"), "cell")
    chance = F.pmod(F.xxhash64("id", F.lit(level)), F.lit(1 << 30)) < F.least(F.lit(float(fan)), F.col("size") * 4 / leaf) * (1 << 30) / F.col("size")  # children of a quarter leaf at least
    sample = cut.filter(chance).select("cell", "id", "x").union(big.select("cell", "least.id", "least.x"))  # one pivot in any case
    picked = sample.groupBy("cell", "id").agg(F.min("x").alias("x"))
    pivots = stage(picked.withColumn("at", F.row_number().over(Window.partitionBy("cell").orderBy("id"))).filter(F.col("at") < WIDTH))

    def assign(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.sort_by("at")
        x, p = matrix(a), matrix(b)
        if not len(x):
            return pa.table({"id": a["id"], "y": a["y"], "x": a["x"], "cell": pa.array([], pa.int64()), "r": pa.array([], pa.float64())})
        at = np.zeros(len(x), int)
        for i in range(0, len(x), step := max(1, _PAIRS // max(1, len(p)))):
            at[i : i + step] = distances(x[i : i + step], p, metric)[0].argmin(axis=1)
        cell = np.asarray(a["cell"]) * WIDTH + np.asarray(b["at"])[at]
        return pa.table({"id": a["id"], "y": a["y"], "x": a["x"], "cell": pa.array(cell), "r": pa.array(paired_distances(x, np.arange(len(x)), p, at, metric))})

    # Few pivots per cell, so that all of a cell's are one block; the rows carry the salt.
    moved = stage(_meet(cut.drop("size"), pivots, assign, f"id long, y {label}, x {kind}, cell long, r double", max(block, WIDTH), F.lit(0)))
    children = moved.groupBy("cell").agg(F.max("r").alias("radius"), F.count(F.lit(1)).alias("n"))
    named = pivots.withColumn("child", F.col("cell") * WIDTH + F.col("at")).select("cell", "child", "x")
    nodes = stage(named.join(children.withColumnRenamed("cell", "child"), "child"))
    # A cell that all its rows went on to be one child of (equal rows) is left as it is.
    same = stage(nodes.join(big, "cell").filter("n = size").select(F.col("child").alias("cell")))
    moved = moved.drop("r")
    return resting.unionByName(moved.join(same, "cell", "left_semi")), moved.join(same, "cell", "left_anti"), nodes


def _down(queries: DataFrame, nodes: DataFrame, metric: str, k: int, block: int, nearest: bool) -> DataFrame:
    """Queries (id, x, bound, cell) one level further: into the nearest child, or into all that the bound doesn't exclude.

    Where these are more than WHOLE of the children and of the cell's rows, the query stays in the cell, which then is compared as a whole.
    """
    kind = queries.schema["x"].dataType.simpleString()

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        x, p = matrix(a), matrix(b)
        if not len(x):
            return a.select(["id", "x", "bound", "cell"])
        child, radius, n, bound = (np.asarray(t[c]) for t, c in ((b, "child"), (b, "radius"), (b, "n"), (a, "bound")))
        rows, cells, bounds, here = [], [], [], np.asarray(a["cell"])
        for i in range(0, len(x), step := max(1, _PAIRS // max(1, len(p)))):
            d, off = distances(x[i : i + step], p, metric)
            limit = bound[i : i + step]
            if (n >= k).any():  # a ball of k rows holds k neighbours
                limit = np.minimum(limit, (d + radius)[:, n >= k].min(axis=1) + 2 * off)
            if nearest:
                row, col = np.arange(len(d)), d.argmin(axis=1)
                cell = child[col]
            else:
                reach = d - radius - 2 * off[:, None] <= limit[:, None]
                whole = (reach @ n > WHOLE * n.sum()) & (reach.sum(axis=1) > WHOLE * len(n))
                row, col = np.nonzero(reach & ~whole[:, None])
                stays = np.flatnonzero(whole)
                row, cell = np.append(row, stays), np.append(child[col], here[i : i + step][stays])
            rows.append(row + i)
            cells.append(cell)
            bounds.append(limit[row])
        at = pa.array(np.concatenate(rows))
        return pa.table({"id": a["id"].take(at), "x": a["x"].take(at), "bound": pa.array(np.concatenate(bounds)), "cell": pa.array(np.concatenate(cells))})

    here = nodes.select("cell").distinct()
    moved = _meet(queries.join(here, "cell", "left_semi"), nodes, work, f"id long, x {kind}, bound double, cell long", max(block, WIDTH), F.lit(0), ASKING)
    return stage(queries.join(here, "cell", "left_anti").unionByName(moved))


def _found(visits: DataFrame, rows: DataFrame, metric: str, k: int, block: int, label: str) -> DataFrame:
    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        ids = np.asarray(b["id"])
        at, to, far = nearest_in(matrix(a), matrix(b), ids, k, metric)
        return pa.table({"id": a["id"].take(pa.array(at)), "neighbour": pa.array(ids[to]), "distance": pa.array(far), "y": b["y"].take(pa.array(to))})

    return _meet(visits.select("id", "x", "cell"), rows, work, f"id long, neighbour long, distance double, y {label}", block, F.xxhash64("id", "y"))


def visits(rows: DataFrame, queries: DataFrame, k: int, metric: str, leaf: int, fan: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(queries, rows) in cells such that every query stands in each cell that can hold one of its k nearest rows, or in one that it lies in.

    Rows stand in the smallest cells; `under` gives them for the cells that queries stand in. Takes rows (id, y, x) and queries (id, x); queries have different ids.
    """
    label = rows.schema["y"].dataType.simpleString()
    rows = rows.withColumn("cell", F.lit(0).cast("long"))
    q = queries.select("id", "x", F.lit(float("inf")).alias("bound"), F.lit(0).cast("long").alias("cell"))
    levels, leaves = [], []
    while len(levels) < DEPTH and (cut := _split(rows, len(levels), metric, leaf, fan, block, label)) is not None:
        resting, rows, nodes = cut
        leaves.append(resting)
        levels.append(nodes)
    if not levels:
        return q, rows
    for resting in leaves:
        rows = rows.unionByName(resting)
    rows, near = stage(rows), stage(q)
    for nodes in levels:
        near = _down(near, nodes, metric, k, block, nearest=True)
    kth = _found(near, rows, metric, k, block, label).groupBy("id").agg(
        F.when(F.count(F.lit(1)) >= k, F.get(F.sort_array(F.collect_list("distance")), F.lit(k - 1))).alias("kth"))
    known = near.select("id", "bound").join(kth, "id", "left").select("id", F.least("bound", F.coalesce("kth", "bound")).alias("bound"))
    q = stage(q.drop("bound").join(known, "id").select("id", "x", "bound", "cell"))
    for nodes in levels:
        q = _down(q, nodes, metric, k, block, nearest=False)
    return q, rows


def under(placed: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows once for each cell that queries stand in and they lie in, which is at most one cell of each level."""
    held = rows.select("cell").distinct().withColumn("whole", F.explode(F.array_distinct(F.array(*[F.shiftright("cell", i * (WIDTH.bit_length() - 1)) for i in range(DEPTH + 1)]))))
    held = stage(held.join(placed.select(F.col("cell").alias("whole")).distinct(), "whole", "left_semi"))
    return rows.join(held, "cell").drop("cell").withColumnRenamed("whole", "cell")


def neighbours(train: DataFrame, queries: DataFrame, features: str, target: str, key: str, k: int,
               metric: str = "euclid", leaf: int = LEAF, fan: int = FAN, block: int = BLOCK) -> DataFrame:
    """The k nearest training rows of each query: (key, rank, neighbour, distance, target). Exact, ties to the smaller key.

    Rows and queries without features take no part; queries have different keys. `metric` is "euclid" or "manhattan".
    `leaf`, `fan` and `block` shape the work, not the result.
    """
    # Single precision stays as it is until it is compared: that is half of the bytes that move.
    kind = "array<float>" if all(isinstance(d.schema[features].dataType, ArrayType) and isinstance(d.schema[features].dataType.elementType, FloatType) for d in (train, queries)) else "array<double>"
    rows = train.filter(F.col(features).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(target).alias("y"), F.col(features).cast(kind).alias("x"))
    q = queries.filter(F.col(features).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(features).cast(kind).alias("x"))
    placed, rows = visits(rows, q, k, metric, leaf, fan, block)
    rows = under(placed, rows)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    found = _found(placed, rows, metric, k, block, rows.schema["y"].dataType.simpleString())
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("id").alias(key), "rank", "neighbour", "distance", F.col("y").alias(target))
