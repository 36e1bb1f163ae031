"""Feature building."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import missing, np_round
from tidewater.operators.windows import global_row_number


def cut(col: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the half-open bin [edge, next edge); outside all bins NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin")
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        cond = (col >= F.lit(low)) & (col < F.lit(high))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def price_per_unit(price: Column, area: Column) -> Column:
    return np_round(F.try_divide(price.cast("double"), area.cast("double")), 2)


# The floor labels of the source data set.
FLOOR_BOTH, FLOOR_FIRST, FLOOR_LAST, FLOOR_OTHER = "Первый и последний", "Первый", "Последний", "Другой"


def floor_type(floor: Column, total: Column) -> Column:
    return (
        F.when((floor == 1) & (floor == total), FLOOR_BOTH)
        .when(floor == 1, FLOOR_FIRST).when(floor == total, FLOOR_LAST).otherwise(FLOOR_OTHER)
    )


def fair_value(df: DataFrame, value: str, keys: Sequence[str], out: str, scale: int = 2) -> DataFrame:
    """Mean of `value` over rows with the same keys, beside every row; NULL where a key is missing.

    The sum is kept in decimals (six places), so a rounded mean does not depend on the order of rows.
    """
    v = missing(F.col(value)).cast("decimal(28,6)")
    means = df.dropna(subset=list(keys)).groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(
        np_round(F.try_divide(F.sum(v).cast("double"), F.count(v)), scale).alias(out))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_g_{k}") for k in keys])
    return df.join(means, on, "left").drop(*[f"_g_{k}" for k in keys])


def label_index(df: DataFrame, col: str, order_by: str | None = None) -> DataFrame:
    """Table (value, code), codes from 0: sorted values, or by first appearance along `order_by`."""
    present = df.filter(F.col(col).isNotNull())
    if order_by is None:
        values, order = present.select(F.col(col).alias("value")).distinct(), [F.col("value").asc()]
    else:
        values = present.groupBy(F.col(col).alias("value")).agg(F.min(order_by).alias("_first"))
        order = [F.col("_first").asc(), F.col("value").asc()]
    return global_row_number(values, order, "_rn").select("value", (F.col("_rn") - 1).alias("code"))


def label_encode(df: DataFrame, col: str, order_by: str | None = None, out: str = "code") -> DataFrame:
    codes = label_index(df, col, order_by).withColumnRenamed("code", out)
    return df.join(codes, F.col(col) == F.col("value"), "left").drop("value")


def one_hot(df: DataFrame, col: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """One boolean column per value, in sorted order."""
    name = prefix or col
    return df.select("*", *[F.coalesce(F.col(col) == v, F.lit(False)).alias(f"{name}_{v}") for v in sorted(values)])


def standardise(df: DataFrame, cols: Sequence[str], scale: int | None = None) -> DataFrame:
    """(x - mean) / population deviation; a zero deviation counts as 1."""
    s = df.agg(F.struct(*[x for c in cols for x in (
        F.avg(missing(F.col(c))).alias(f"m_{c}"), F.stddev_pop(missing(F.col(c))).alias(f"d_{c}"))])).scalar()
    base = df.withColumn("_s", s)
    def z(c: str) -> Column:
        dev = F.when(F.col(f"_s.d_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s.d_{c}"))
        value = (missing(F.col(c)) - F.col(f"_s.m_{c}")) / dev
        return np_round(value, scale) if scale is not None else value
    return base.select(*[z(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def key_share(key: Column, parts: int) -> Column:
    """A share number from 0 to parts - 1 for a whole-number key, by arithmetic that any engine can repeat."""
    mixed = F.pmod(key.cast("long"), F.lit(1_000_003)) * 7919 + 104_729
    return F.floor(F.pmod(mixed, F.lit(1_000_003)) * parts / 1_000_003).cast("int")


def hash_split(df: DataFrame, key: str, pct: int) -> tuple[DataFrame, DataFrame]:
    """Train / validation by a hash of the whole-number key: the same rows on every run and every cluster."""
    side = key_share(F.col(key), 100) < pct
    return df.filter(side), df.filter(~side)
