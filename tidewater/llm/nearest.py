"""Approximate nearest neighbours: a forest of random-projection trees searched through one shared queue per query.

The forest is fitted on a bounded sample and indexes every row. A query walks all trees at once: one
priority queue holds the open branches of all of them, keyed by the smallest margin on the way, until
enough leaves are collected. The rows of those leaves are ranked by their exact distance.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_rows, mixed, staged

#: Leaves hold up to 128 sample rows, so a tree has 256 leaves at most; 240 of the forest's 1,024 leaves are
#: searched. Vectors without any structure need that many for a recall of 0.9; clustered ones need fewer.
TREES, LEAF, LEAVES = 4, 128, 240
#: Rows the forest is fitted on, at most; a larger sample and smaller leaves give a finer forest.
SAMPLE = 20_000
#: Rows of one leaf that one task ranks together, on average.
SLICE = 4_096


class Forest:
    """Trees as flat arrays: normals, offsets, children (a leaf is the negated leaf number less one)."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.normals, self.offsets, self.children, self.roots, self.leaves = [], [], [], [], 0
        for _ in range(trees):
            self.roots.append(self._grow(sample, np.arange(len(sample)), leaf, rng))
        self.normals = np.array(self.normals).reshape(-1, sample.shape[1])
        self.offsets, self.children = np.array(self.offsets), np.array(self.children, np.int64).reshape(-1, 2)

    def _grow(self, sample: np.ndarray, rows: np.ndarray, leaf: int, rng) -> int:
        if len(rows) > leaf:
            for _ in range(3):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                normal = a - b
                size = np.linalg.norm(normal)
                if not size:
                    continue
                side = sample[rows] @ (normal / size)
                offset = float(np.median(side))
                left = side < offset
                if 0 < left.sum() < len(rows):
                    node = len(self.normals)
                    self.normals.append(normal / size)
                    self.offsets.append(offset)
                    self.children.append((0, 0))
                    self.children[node] = (self._grow(sample, rows[left], leaf, rng), self._grow(sample, rows[~left], leaf, rng))
                    return node
        self.leaves += 1
        return -self.leaves

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, trees) leaf numbers."""
        out = np.zeros((len(vectors), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(vectors), root)
            while (inner := np.flatnonzero(at >= 0)).size:
                node = at[inner]
                side = np.einsum("ij,ij->i", vectors[inner], self.normals[node])
                at[inner] = self.children[node, (side >= self.offsets[node]).astype(int)]
            out[:, t] = -at - 1
        return out

    def search(self, vector: np.ndarray, most: int) -> list[int]:
        """The `most` leaves with the largest smallest margin, over all trees."""
        queue, found = [(-math.inf, root) for root in self.roots], []
        heapq.heapify(queue)
        while queue and len(found) < most:
            low, node = heapq.heappop(queue)
            if node < 0:
                found.append(-node - 1)
                continue
            margin = float(self.normals[node] @ vector - self.offsets[node])
            left, right = (int(c) for c in self.children[node])
            heapq.heappush(queue, (max(low, margin), left))
            heapq.heappush(queue, (max(low, -margin), right))
        return found


def _valid(v: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


def _first_ids(rows: DataFrame, n: int) -> DataFrame:
    """(vector, ids): the n smallest ids of each distinct vector. Copies beyond them can't be among n nearest.

    Ranked twice, first within hash shares of a vector's ids: a vector that a third of the rows hold
    meets in no task as a whole, and the ranks are limited before each shuffle.
    """
    share = F.pmod(F.xxhash64("vec_id"), F.lit(16))
    first = Window.partitionBy("vector", "_share").orderBy("vec_id")
    whole = Window.partitionBy("vector").orderBy("vec_id")
    return (
        rows.withColumn("_share", share)
        .withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= n)
        .withColumn("_n", F.row_number().over(whole)).filter(F.col("_n") <= n)
        .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )


def nearest(
    vectors: DataFrame, queries: Column, k: int = 10, trees: int = TREES, leaf: int = LEAF, leaves: int = LEAVES,
    sample: int = SAMPLE, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row that `queries` selects.

    Nearness is the Euclidean distance in double precision; ties go to the smaller id; the query's own
    id is no candidate. Rows without an id, or whose vector is null, zero, of another length than most,
    or holds null or non-finite components take no part. Rows repeated with id and vector count once.
    Fewer than k candidates give fewer rows, an empty table gives none.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("vector"), queries.alias("is_query"),
    ).filter(F.col("vec_id").isNotNull() & _valid(F.col("vector")))
    width = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").head()
    empty = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return spark.createDataFrame([], empty)
    rows = rows.filter(F.size("vector") == width["width"])
    distinct = staged(_first_ids(rows.select("vec_id", "vector").distinct(), k + 1))
    n = distinct.count()
    fraction = (1 << 30) * min(1.0, sample / n)
    own = distinct.filter(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(fraction)).orderBy(F.xxhash64("vector"), "vector").limit(sample)
    points = np.array([r[0] for r in own.select("vector").collect()], np.float64).reshape(-1, width["width"])
    if not len(points):
        points = np.array([distinct.select("vector").head()[0]], np.float64)
    forest = Forest(points, trees, leaf)
    shared = spark.sparkContext.broadcast(forest)
    slices = max(1, math.ceil(n * trees / max(1, forest.leaves) / SLICE))

    pairs = pa.schema([("leaf", pa.int64()), ("slice", pa.int64()), ("query_id", pa.int64()), ("vector", pa.binary()), ("ids", pa.list_(pa.int64()))])
    kind = "leaf long, slice long, query_id long, vector binary, ids array<long>"

    def matrix(column) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return np.ascontiguousarray(flat, np.float64).reshape(len(column), -1)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                m = matrix(batch.column(0))
                ids, number = batch.column(1).to_pylist(), shared.value.leaves_of(m)
                share = (mixed(np.array([i[0] for i in ids], np.int64).view(np.uint64)) % np.uint64(slices)).astype(np.int64)
                for t in range(number.shape[1]):
                    yield arrow_rows(pairs, {"leaf": number[:, t], "slice": share, "query_id": [None] * len(ids), "vector": [v.tobytes() for v in m], "ids": ids})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                m, ids = matrix(batch.column(1)), batch.column(0).to_pylist()
                out = {f.name: [] for f in pairs}
                for query, v in zip(ids, m):
                    for number in shared.value.search(v, leaves):
                        for s in range(slices):
                            for name, value in zip(out, (number, s, query, v.tobytes(), None)):
                                out[name].append(value)
                yield arrow_rows(pairs, out)

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        queries, found, scores = [], [], []
        if len(left) and len(right):
            m = np.frombuffer(b"".join(left["vector"]), np.float64).reshape(len(left), -1)
            sizes = left["ids"].str.len().to_numpy()
            row, ids = np.repeat(np.arange(len(left)), sizes), np.concatenate(left["ids"].to_numpy())
            for query, raw in zip(right["query_id"], right["vector"]):
                far = np.sqrt(((m - np.frombuffer(raw, np.float64)) ** 2).sum(1))[row]
                # Only what isn't farther than the k + 1 nearest has to be ordered; one of them may be the query itself.
                near = np.flatnonzero(far <= np.partition(far, k)[k]) if len(far) > k + 1 else np.arange(len(far))
                best = near[np.lexsort((ids[near], far[near]))]
                best = best[ids[best] != query][:k]
                queries.append(np.full(len(best), query, np.int64))
                found.append(ids[best])
                scores.append(far[best])
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pd.DataFrame({"query_id": joined(queries, np.int64), "vec_id": joined(found, np.int64), "score": joined(scores, np.float64)})

    indexed = distinct.select("vector", "ids").mapInArrow(index, kind)
    asked = rows.filter("is_query").select("vec_id", "vector").distinct().mapInArrow(ask, kind)
    best = indexed.groupBy("leaf", "slice").cogroup(asked.groupBy("leaf", "slice")).applyInPandas(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        best.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
