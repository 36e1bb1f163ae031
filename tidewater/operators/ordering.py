"""Sorting and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_with_ties(df: DataFrame, by: str, k: int, desc: bool = True, rank_col: str | None = None) -> DataFrame:
    """Rows whose dense rank by `by` is at most k.

    The k best distinct values come from a distributed top-k; the worst of them is a filter on the
    rows. No row passes through a one-task window, and nulls are never ranked.
    """
    order = F.col(by).desc() if desc else F.col(by).asc()
    best = df.select(by).filter(F.col(by).isNotNull()).distinct().orderBy(order).limit(k)
    edge = best.agg((F.min if desc else F.max)(by)).scalar()
    kept = df.filter(F.col(by) >= edge if desc else F.col(by) <= edge)
    if rank_col is None:
        return kept
    ranks = best.select(F.col(by).alias("_b"), F.row_number().over(Window.orderBy(
        F.col(by).desc() if desc else F.col(by).asc())).cast("long").alias(rank_col))
    return kept.join(F.broadcast(ranks), F.col(by) == F.col("_b")).drop("_b")


def top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys with their counts, ties by key."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.col("cnt").desc(), F.col(key).asc()).limit(k)


def restrict_to_top(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of the k most frequent keys; the broadcast side has k rows."""
    return df.join(F.broadcast(top_keys(df, key, k).select(key)), key, "left_semi")


def last_n(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The n largest rows by key, in ascending order."""
    tail = df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n)
    return tail.orderBy(*[F.col(c).asc() for c in order_by])


def nth_row(df: DataFrame, order_by: Sequence[str], n: int, from_end: bool = False) -> DataFrame:
    """The n-th row (1-based) from either end; empty when there are fewer."""
    sort = [F.col(c).desc() if from_end else F.col(c).asc() for c in order_by]
    back = [F.col(c).asc() if from_end else F.col(c).desc() for c in order_by]
    first = df.orderBy(*sort).limit(n)
    enough = first.agg(F.count(F.lit(1)) == n).scalar()
    return first.orderBy(*back).limit(1).filter(enough)
