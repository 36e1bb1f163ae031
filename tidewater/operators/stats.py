"""Statistics: exact quantiles, counts of values, summaries, correlation, association."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.numbers import missing
from tidewater.operators.selection import exact_quantiles, quantile_numbers  # noqa: F401


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Value and count (or share of the non-null rows)."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    if not normalize:
        return counts
    total = df.agg(F.count(col)).scalar()
    return counts.select(col, (F.col("cnt") / total).alias("share"))


def extreme_value(df: DataFrame, col: str, most: bool = True) -> DataFrame:
    """The most (least) frequent value and its count; ties by the larger (smaller) value."""
    pick = F.max if most else F.min
    best = value_counts(df, col).agg(pick(F.struct("cnt", F.col(col).alias("value"))).alias("s"))
    return best.select("s.value", "s.cnt")


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value, the smallest on ties."""
    counts = value_counts(df, col)
    return counts.agg(F.min_by(F.col(col), F.struct((-F.col("cnt")).alias("c"), F.col(col).alias("v"))).alias("value"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), missing(F.col(c)).alias("v")) for c in cols])).alias("s")).select("s.*")
    base = long.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    quart = exact_quantiles(long, "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by=["column"])
    return base.join(quart, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: count, unique, top (smallest on ties), freq."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s")).select("s.*")
    counts = long.filter(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("v", F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))).alias("top"), F.max("n").alias("freq"))


def pearson(x: Column, y: Column) -> Column:
    """Pearson r as an aggregate over rows where both are present; NULL for a constant column."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.try_divide(F.covar_pop(a, b), F.when(spread > 0, spread))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form (a, b, r) for every ordered pair, from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), pearson(F.col(a), F.col(b)).alias("r")) for a, b in pairs
    ]).alias("m"))
    half = one.select(F.explode("m").alias("s")).select("s.*")
    return half.unionByName(half.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of the least-squares line."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))


def _cells(df: DataFrame, cols: Sequence[str], interval_cols: Sequence[str], bins: int) -> DataFrame:
    """Contingency tables (a, b, x, y, o) of all column pairs a < b, from one pass that counts on the map side."""
    src = df
    if interval_cols:
        edges = df.agg(F.struct(*[f(F.col(c).cast("double")).alias(f"{n}_{c}")
                                  for c in interval_cols for n, f in (("lo", F.min), ("hi", F.max))])).scalar()
        src = src.withColumn("_e", edges)
    def level(c: str) -> Column:
        if c not in interval_cols:
            return F.col(c).cast("string")
        lo, hi = F.col(f"_e.lo_{c}"), F.col(f"_e.hi_{c}")
        width = F.try_divide(F.col(c).cast("double") - lo, hi - lo) * bins
        return F.least(F.floor(F.coalesce(width, F.lit(0.0))), F.lit(bins - 1)).cast("string")
    leveled = src.select(*[F.when(F.col(c).isNotNull(), level(c)).alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    return leveled.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")) for a, b in pairs
    ])).alias("s")).select("s.*").filter("x IS NOT NULL AND y IS NOT NULL").groupBy("a", "b", "x", "y").agg(
        F.count(F.lit(1)).cast("double").alias("o"))


def association_matrix(df: DataFrame, cols: Sequence[str], interval_cols: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """Chi-square and Cramer's V for each pair of columns (a < b), numbers cut in equal-width bins.

    One pass expands a row to its column pairs and counts combinations on the map side; what
    follows works on contingency tables only.
    """
    cells = _cells(df, cols, interval_cols, bins)
    rows = cells.groupBy("a", "b", "x").agg(F.sum("o").alias("rx"))
    columns = cells.groupBy("a", "b", "y").agg(F.sum("o").alias("cy"))
    totals = cells.groupBy("a", "b").agg(
        F.sum("o").alias("n"), F.count_distinct("x").alias("kx"), F.count_distinct("y").alias("ky"))
    # chi2 = n * (sum(o^2 / (row * col)) - 1), so absent combinations need no row.
    terms = cells.join(rows, ["a", "b", "x"]).join(columns, ["a", "b", "y"]).groupBy("a", "b").agg(
        F.sum(F.col("o") * F.col("o") / (F.col("rx") * F.col("cy"))).alias("s"))
    chi2 = F.col("n") * (F.col("s") - 1)
    free = F.least("kx", "ky") - 1
    return terms.join(totals, ["a", "b"]).select(
        "a", "b", chi2.alias("chi2"), F.sqrt(F.try_divide(F.greatest(chi2, F.lit(0.0)), F.col("n") * free)).alias("cramers_v"))


def _normal_cells(rho: float, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Probabilities of a standard binormal over cells whose borders are quantiles u and v (0 to 1)."""
    if rho >= 1:
        return np.clip(np.minimum(u[1:, None], v[None, 1:]) - np.maximum(u[:-1, None], v[None, :-1]), 0, None)
    normal = NormalDist()
    nodes, weights = np.polynomial.legendre.leggauss(32)
    at = (u[:-1, None] + u[1:, None]) / 2 + (u[1:, None] - u[:-1, None]) / 2 * nodes
    x = np.vectorize(normal.inv_cdf)(np.clip(at, 1e-15, 1 - 1e-15))
    y = np.array([-np.inf, *map(normal.inv_cdf, v[1:-1]), np.inf])
    below = np.vectorize(normal.cdf)((y - rho * x[:, :, None]) / math.sqrt(1 - rho * rho))
    return ((np.diff(below, axis=2) * weights[:, None]).sum(1)) * ((u[1:] - u[:-1]) / 2)[:, None]


def phi_k(chi2: float, rows: Sequence[float], columns: Sequence[float]) -> float:
    """The binormal correlation whose table of the same margins has this chi-square, less what chance alone gives (0 to 1)."""
    r, c = np.array(rows, float), np.array(columns, float)
    n, top = r.sum(), min(len(r), len(c)) - 1
    free = (len(r) - 1) * (len(c) - 1)
    if top < 1 or chi2 <= free:
        return 0.0
    if chi2 >= n * top:
        return 1.0
    u, v = (np.append(0, np.cumsum(m)) / n for m in (r, c))
    even = np.outer(r, c) / n / n
    size = lambda rho: n * float((((_normal_cells(rho, u, v)) - even) ** 2 / even).sum())
    wanted = (chi2 - free) * size(1.0) / (n * top - free)
    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if size(middle) < wanted else (low, middle)
    return (low + high) / 2


def phi_k_matrix(df: DataFrame, cols: Sequence[str], interval_cols: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """(a, b, phi_k) for each pair of columns (a < b), numbers cut in equal-width bins.

    The tables are counted in Spark; each pair's margins, as long as its columns have levels, go to one
    small numeric root.
    """
    cells = _cells(df, cols, interval_cols, bins)
    margins = cells.groupBy("a", "b", F.lit(0).alias("side"), F.col("x").alias("level")).agg(F.sum("o").alias("m")).unionByName(
        cells.groupBy("a", "b", F.lit(1).alias("side"), F.col("y").alias("level")).agg(F.sum("o").alias("m")))
    both = margins.join(association_matrix(df, cols, interval_cols, bins).select("a", "b", "chi2"), ["a", "b"])

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("level")
        sides = [rows["m"][rows["side"] == side].tolist() for side in (0, 1)]
        return pd.DataFrame({"a": rows["a"].iloc[:1], "b": rows["b"].iloc[:1], "phi_k": [phi_k(float(rows["chi2"].iloc[0]), *sides)]})

    return both.groupBy("a", "b").applyInPandas(solve, "a string, b string, phi_k double")
