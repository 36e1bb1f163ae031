"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], drop_null_keys: bool = False) -> DataFrame:
    """Aggregates per key. SQL keeps the NULL group; `drop_null_keys` leaves it out, as data-frame libraries do."""
    src = df.dropna(subset=list(keys)) if drop_null_keys else df
    return src.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def pivot_mean(df: DataFrame, index: str, column: str, values: Sequence, value: str, margin: str | None = None) -> DataFrame:
    """Mean of `value` per index and column; `margin` names an extra column with the row mean.

    The column values are given, so the pivot needs no extra pass. All cells come from one aggregation.
    """
    cells = [F.avg(F.when(F.col(column) == v, F.col(value))).alias(str(v)) for v in values]
    if margin:
        cells.append(F.avg(value).alias(margin))
    return df.groupBy(index).agg(*cells)


def rows_at_extreme(df: DataFrame, col: str, largest: bool = True) -> DataFrame:
    """All rows that hold the column's largest (smallest) value."""
    edge = df.agg((F.max if largest else F.min)(col)).scalar()
    return df.filter(F.col(col) == edge)


def arg_max_row(df: DataFrame, keys: Sequence[str], value: str, tie: str) -> DataFrame:
    """The row with the largest value of each key; the smallest `tie` on equal values."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct((-F.col(value)).alias("v"), tie)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def member_lists(df: DataFrame, key: str, member: str) -> DataFrame:
    """(key, line): 'key (count): a, b, c.' with the different members sorted.

    Members are made distinct in a shuffle of their own first. The line holds all members of its
    key, because that line is the result.
    """
    pairs = df.select(F.col(key).cast("string").alias(key), F.col(member).cast("string").alias("_m")).distinct()
    listed = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.expr("listagg(_m, ', ') WITHIN GROUP (ORDER BY _m)").alias("_l"))
    return listed.select(key, F.format_string("%s (%d): %s.", key, "_n", "_l").alias("line"))
