"""Unions, differences, duplicates and concatenation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.windows import global_row_number


def union_tagged(frames: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """All rows of several frames with a literal tag."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.select(F.lit(t).alias(tag), "*") for t, df in frames.items()])


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows.

    Texts are told by their 256-bit digest and length, so that whole texts aren't shuffled.
    """
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    keys = [F.sha2(c, 256) if c in texts else F.col(c) for c in df.columns] + [F.length(c) for c in texts]
    per = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_c"))
    return per.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0).cast("long")).alias("duplicates"))


def keep_first(df: DataFrame, subset: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the first along `order_by`.

    An aggregate, not a window: copies of a frequent key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in subset]
    first = df.groupBy(*subset).agg(F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_r"))
    return first.select(*[F.col(c) if c in subset else F.col(f"_r.{c}").alias(c) for c in df.columns])


def union_first_seen(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Distinct rows over all frames with `seen`, the number of the frame where each first appears."""
    tagged = reduce(lambda a, b: a.unionByName(b), [df.withColumn("seen", F.lit(i)) for i, df in enumerate(frames)])
    return tagged.groupBy(*key).agg(F.min("seen").alias("seen"))


def concat_columns(left: DataFrame, right: DataFrame, left_order: Sequence[Column], right_order: Sequence[Column]) -> DataFrame:
    """Put two frames side by side by row position; the shorter one is padded with nulls."""
    a = global_row_number(left, left_order, "row_no")
    b = global_row_number(right, right_order, "row_no")
    return a.join(b, "row_no", "full")


def in_all_lists(df: DataFrame, list_id: str, items: str, lists: int) -> DataFrame:
    """Items that occur in each of `lists` different lists; repeats inside one list count once."""
    pairs = df.select(F.col(list_id), F.explode(F.array_distinct(items)).alias("item"))
    return pairs.groupBy("item").agg(F.count_distinct(list_id).alias("n")).filter(F.col("n") == lists).select("item")
