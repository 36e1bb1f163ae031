"""Models: nearest neighbours, gradient fits, and their scores."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.neighbours import neighbours


def knn(train: DataFrame, queries: DataFrame, features: str, target: str, key: str, k: int,
        metric: str = "euclid", mode: str = "classify", out: str = "predicted") -> DataFrame:
    """(key, predicted): majority of the k nearest, smallest label on ties, or their mean."""
    near = neighbours(train, queries, features, target, key, k, metric)
    if mode == "regress":
        return near.groupBy(key).agg(F.avg(target).alias(out))
    votes = near.groupBy(key, target).agg(F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(key).agg(F.min_by(target, F.struct((-F.col("_n")).alias("n"), F.col(target).alias("v"))).alias(out))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("cnt"))


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(truth) == F.col(predicted)).cast("double")).alias("accuracy"))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F-score and support per label; a missing denominator gives 0."""
    pairs = confusion(df, truth, predicted)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col(truth).alias("label"), F.col("cnt").alias("support"), F.lit(0).cast("long").alias("called"),
                 F.when(F.col(truth) == F.col(predicted), F.col("cnt")).otherwise(0).alias("hit")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).cast("long").alias("support"), F.col("cnt").alias("called"),
                 F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    per = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("called")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hit"), F.col("support")), F.lit(0.0))
    scored = per.select("label", precision.alias("precision"), recall.alias("recall"), "support")
    f = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return scored.select("label", "precision", "recall", f.alias("f_score"), "support")


def regression_errors(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    gap = F.col(truth).cast("double") - F.col(predicted).cast("double")
    return df.agg(F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae"), F.max(F.abs(gap)).alias("max_error"))


def count_differences(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose value differs between two prediction sets."""
    other = b.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    return a.join(other, F.col(key) == F.col("_k")).agg(F.count_if(F.col(value) != F.col("_v")).alias("different"))


def _moments(df: DataFrame, features: Sequence[str], target: str) -> tuple[np.ndarray, np.ndarray, float]:
    """X'X / n, X'y / n and n with a leading constant 1, from one aggregation."""
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    y = F.col(target).cast("double")
    known = df.dropna(subset=[*features, target])
    d = len(cols)
    sums = [F.sum(cols[i] * cols[j]) for i in range(d) for j in range(i, d)] + [F.sum(c * y) for c in cols]
    row = known.agg(F.array(*sums).alias("s"), F.count(F.lit(1)).alias("n")).first()
    n = float(row["n"])
    xx = np.zeros((d, d))
    at = 0
    for i in range(d):
        for j in range(i, d):
            xx[i, j] = xx[j, i] = row["s"][at]
            at += 1
    return xx / n, np.array(row["s"][at:]) / n, n


def _path_frame(spark, path: list[list[float]]) -> DataFrame:
    return spark.createDataFrame([(i, w) for i, w in enumerate(path)], "step int, weights array<double>")


def fit_gd(df: DataFrame, features: Sequence[str], target: str, lr: float = 1.0, n_iter: int = 1500,
           threshold: float = 1e-5, decay: float = 0.001, floor: float = 0.001) -> DataFrame:
    """Full-batch descent for least squares with steps of length lr along the gradient's direction.

    The rate falls by `decay` each step down to `floor`; the path ends when the gradient is
    shorter than `threshold`. The gradient over all rows is 2(X'X w - X'y)/n, so the table is read once
    and the steps use a matrix as wide as the feature list. Output: the path (step, weights).
    """
    xx, xy, _ = _moments(df, features, target)
    w = np.zeros(len(xy))
    path = [w.tolist()]
    for _ in range(n_iter):
        g = 2 * (xx @ w - xy)
        size = float(np.linalg.norm(g))
        if size < threshold:
            break
        w = w - lr * g / size
        path.append(w.tolist())
        lr = max(lr - decay, floor)
    return _path_frame(df.sparkSession, path)


def fit_rmsprop(df: DataFrame, features: Sequence[str], target: str, lr: float = 1.0, n_iter: int = 150,
                beta: float = 0.9, threshold: float = 1e-5, eps: float = 1e-4, decay: float = 0.001,
                floor: float = 0.001) -> DataFrame:
    """Descent scaled per weight by the running mean of squared gradients: m = (1 - beta) m + beta g^2.

    The path ends when a step is shorter than `threshold`.
    """
    xx, xy, _ = _moments(df, features, target)
    w, m = np.zeros(len(xy)), np.zeros(len(xy))
    path = [w.tolist()]
    for _ in range(n_iter):
        g = 2 * (xx @ w - xy)
        m = (1 - beta) * m + beta * g * g
        move = lr * g / np.sqrt(m + eps)
        if float(np.linalg.norm(move)) < threshold:
            break
        w = w - move
        path.append(w.tolist())
        lr = max(lr - decay, floor)
    return _path_frame(df.sparkSession, path)
