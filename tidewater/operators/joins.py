"""Join forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equi_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner", match_nulls: bool = False) -> DataFrame:
    """Join on keys of different names, keeping both. NULL keys do not match unless `match_nulls`."""
    cond = None
    for a, b in on.items():
        one = left[a].eqNullSafe(right[b]) if match_nulls else left[a] == right[b]
        cond = one if cond is None else cond & one
    return left.join(right, cond, how)


def full_with_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on equal names; each key is taken from whichever side has it."""
    return left.join(right, list(keys), "full")


def with_scalars(df: DataFrame, source: DataFrame, **aggs: Column) -> DataFrame:
    """Put one-row aggregates of `source` beside every row, as scalar subqueries instead of a cross join."""
    one = source.agg(F.struct(*[c.alias(n) for n, c in aggs.items()])).scalar()
    return df.select("*", *[one[n].alias(n) for n in aggs])


def anti_keys(left: DataFrame, key: str, right: DataFrame, other: str) -> DataFrame:
    """Different keys of `left` that `right` lacks."""
    return left.select(key).distinct().join(right.select(F.col(other).alias("_o")), F.col(key) == F.col("_o"), "left_anti")


def join_aggregates(df: DataFrame, key: str, first: Mapping[str, Column], other: DataFrame, other_key: str,
                    second: Mapping[str, Column]) -> DataFrame:
    """Aggregate both sides per key, then join: each key meets once."""
    a = df.groupBy(key).agg(*[c.alias(n) for n, c in first.items()])
    b = other.groupBy(F.col(other_key).alias("_k")).agg(*[c.alias(n) for n, c in second.items()])
    return a.join(b, F.col(key) == F.col("_k")).drop("_k")
