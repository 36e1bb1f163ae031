"""Signals: fixed chunks, principal components and their inverse."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.windows import global_row_number


def to_mono(df: DataFrame, channels: Sequence[str], out: str = "mono") -> DataFrame:
    """Mean of the channels of each sample."""
    total = F.lit(0.0)
    for c in channels:
        total = total + F.col(c).cast("double")
    return df.withColumn(out, total / len(channels))


def chunk(df: DataFrame, order_by: Sequence[str], value: str, size: int) -> DataFrame:
    """(chunk_id, samples): the series in order, cut every `size` samples, zeros at the end of the last."""
    numbered = global_row_number(df, [F.col(c).asc() for c in order_by], "_rn")
    place = F.col("_rn") - 1
    cells = numbered.select(
        F.floor(place / size).cast("long").alias("chunk_id"), F.pmod(place, F.lit(size)).alias("pos"),
        F.col(value).cast("double").alias("v"))
    rows = cells.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("s"))
    got = F.transform("s", lambda x: x["v"])
    return rows.select("chunk_id", F.concat(got, F.array_repeat(F.lit(0.0), F.lit(size) - F.size(got))).alias("samples"))


def unchunk(df: DataFrame, size: int, n: int, col: str = "samples") -> DataFrame:
    """(pos, v) of the first n samples, zero-based."""
    flat = df.select("chunk_id", F.posexplode(col).alias("p", "v"))
    return flat.select((F.col("chunk_id") * size + F.col("p")).alias("pos"), "v").filter(F.col("pos") < n)


class Components:
    """Mean and loadings of a fit; both are as wide as one row, never as long as the table."""

    def __init__(self, mean: list[float], loadings: list[list[float]], explained: list[float]):
        self.mean, self.loadings, self.explained = mean, loadings, explained

    def to_frame(self, spark) -> DataFrame:
        rows = [(-1, self.mean, None)] + [(i, c, e) for i, (c, e) in enumerate(zip(self.loadings, self.explained))]
        return spark.createDataFrame(rows, "component int, weights array<double>, explained double")

    @classmethod
    def from_frame(cls, df: DataFrame) -> Components:
        rows = {r["component"]: r for r in df.collect()}
        ids = sorted(i for i in rows if i >= 0)
        return cls(list(rows[-1]["weights"]), [list(rows[i]["weights"]) for i in ids], [rows[i]["explained"] for i in ids])


def pca_fit(df: DataFrame, col: str, k: int) -> Components:
    """k principal components of an array column; each is signed so that its largest loading is positive."""
    vectors = df.select(array_to_vector(F.col(col).cast("array<double>")).alias("x"))
    model = PCA(k=k, inputCol="x", outputCol="s").fit(vectors)
    mean = vectors.agg(Summarizer.mean(F.col("x")).alias("m")).first()["m"]
    matrix = model.pc.toArray()
    loadings = []
    for i in range(k):
        c = matrix[:, i]
        loadings.append([float(x) for x in (c if c[abs(c).argmax()] > 0 else -c)])
    return Components([float(x) for x in mean], loadings, [float(x) for x in model.explainedVariance])


def _affine(matrix: np.ndarray, before: np.ndarray, after: np.ndarray):
    """Arrow-batched x -> (x - before) @ matrix + after; the matrix is as small as the fit."""

    @F.pandas_udf("array<double>")
    def apply(rows: pd.Series) -> pd.Series:
        if rows.empty:
            return pd.Series([], dtype=object)
        block = np.stack(rows.to_numpy()).astype("float64")
        return pd.Series(list((block - before) @ matrix + after))

    return apply


def pca_transform(df: DataFrame, col: str, fit: Components, out: str = "scores") -> DataFrame:
    """Scores of the centred rows."""
    loadings = np.array(fit.loadings)
    return df.withColumn(out, _affine(loadings.T, np.array(fit.mean), np.zeros(len(loadings)))(F.col(col)))


def pca_inverse(df: DataFrame, scores: str, fit: Components, out: str = "restored") -> DataFrame:
    """Scores back to rows: scores times loadings plus mean."""
    loadings = np.array(fit.loadings)
    return df.withColumn(out, _affine(loadings, np.zeros(len(loadings)), np.array(fit.mean))(F.col(scores)))


def pca_curve(df: DataFrame, col: str, fit: Components, ks: Sequence[int]) -> DataFrame:
    """(k, explained, mse, compression) for each k <= the fitted number, from one pass over the rows.

    Loadings are orthonormal, so the error of keeping k components is the squared length of the
    centred row minus that of its first k scores.
    """
    width = len(fit.mean)
    scored = pca_transform(df.select(col), col, fit)
    mean = np.array(fit.mean)

    @F.pandas_udf("double")
    def squared_length(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: float((((np.asarray(r, dtype="float64")) - mean) ** 2).sum()))

    kept = [F.sum(F.aggregate(F.slice("scores", 1, k), F.lit(0.0), lambda a, x: a + x * x)).alias(f"k{k}") for k in ks]
    sums = scored.select(squared_length(F.col(col)).alias("_len"), "scores").agg(
        F.sum("_len").alias("total"), F.count(F.lit(1)).alias("n"), *kept)
    explained = list(np.cumsum(fit.explained))
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(float(explained[k - 1])).alias("explained"),
                 ((F.col("total") - F.col(f"k{k}")) / (F.col("n") * width)).alias("mse"),
                 F.lit(width / k).alias("compression")) for k in ks])).alias("s")).select("s.*")


def choose_k(fit: Components, share: float = 0.95) -> int:
    """Fewest components whose explained variance reaches `share` (all of them when none does)."""
    reached = np.cumsum(fit.explained) >= share
    return int(reached.argmax()) + 1 if reached.any() else len(fit.explained)
