"""Joins on time ranges and on name patterns, without theta joins over facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.staging import Scan, scan_along, stage


def bucket_spine(spark: SparkSession, start: str, stop: str, step: str = "1 HOUR", out: str = "from_ts") -> DataFrame:
    """One row per bucket start in [start, stop)."""
    series = F.sequence(
        F.lit(start).cast("timestamp_ntz"),
        F.lit(stop).cast("timestamp_ntz") - F.expr(f"INTERVAL {step}"),
        F.expr(f"INTERVAL {step}"),
    )
    return spark.range(1).select(F.explode(series).alias(out))


def left_bucket_join(spine: DataFrame, df: DataFrame, ts: str, aggs: Mapping[str, Column],
                     unit: str = "hour", spine_col: str = "from_ts") -> DataFrame:
    """Aggregate `df` per `unit` of `ts` and join the result to the spine; buckets without rows stay.

    The range condition `from <= ts < from + unit` becomes an equality on the truncated time.
    """
    per_bucket = df.groupBy(F.date_trunc(unit, ts).cast("timestamp_ntz").alias("_b")).agg(
        *[c.alias(o) for o, c in aggs.items()])
    return spine.join(per_bucket, F.col(spine_col) == F.col("_b"), "left").drop("_b")


def interval_counts(intervals: DataFrame, start: str, stop: str, probes: DataFrame | None = None) -> DataFrame:
    """For each probe [start, stop]: intervals still open at its stop (`in_air`) and ended before its start (`finished`).

    Open at a time means start <= time < stop. With start <= stop on every interval these are differences of
    running counts over the distinct times, so intervals and probes are never paired. Without `probes` (same column
    names) the intervals are the probes. Both sides are read once, into one table of different spans with their
    numbers, and one sweep over its times serves all. Probes with zero in both counts are left out, as are spans
    with a missing end.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    both = intervals.select(F.col(start).alias("_s"), F.col(stop).alias("_e"), one.alias("_n"), F.lit(probes is None).alias("_asked"))
    if probes is not None:
        both = both.unionByName(probes.select(F.col(start).alias("_s"), F.col(stop).alias("_e"), zero.alias("_n"), F.lit(True).alias("_asked")))
    spans = stage(both.filter("_s IS NOT NULL AND _e IS NOT NULL").groupBy("_s", "_e").agg(F.sum("_n").alias("_n"), F.max("_asked").alias("_asked")))
    weight = F.when(F.col("_s") <= F.col("_e"), F.col("_n")).otherwise(0)
    marks = spans.select(F.explode(F.array(
        F.struct(F.col("_s").alias("t"), weight.alias("opened"), zero.alias("closed")),
        F.struct(F.col("_e").alias("t"), zero.alias("opened"), weight.alias("closed")))).alias("m")).select("m.*")
    times = marks.groupBy("t").agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"))
    timeline = stage(scan_along(times, [F.col("t").asc()], {
        "opened_upto": Scan("sum", F.col("opened")), "closed_upto": Scan("sum", F.col("closed"))}))
    at_stop = timeline.select(F.col("t").alias("_e"), (F.col("opened_upto") - F.col("closed_upto")).alias("in_air"))
    at_start = timeline.select(F.col("t").alias("_s"), (F.col("closed_upto") - F.col("closed")).alias("finished"))
    return (
        spans.filter("_asked").select("_s", "_e").join(at_stop, "_e").join(at_start, "_s")
        .filter((F.col("in_air") > 0) | (F.col("finished") > 0))
        .select(F.col("_s").alias(start), F.col("_e").alias(stop), "in_air", "finished")
    )


def nearest_group(df: DataFrame, groups: DataFrame, value: str, group: str, center: str, key: str,
                  signed: bool = False) -> DataFrame:
    """For each row the group whose `center` is nearest to `value`; ties go to the smaller group name.

    Rows and centers are sorted on one line and the neighbours on both sides are carried along it,
    so the rows are not paired with the groups. `signed=True` ranks value - center instead of its
    absolute value (the largest center wins).
    """
    points = df.select(F.col(key).alias("_id"), F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    known = groups.filter(F.col(center).isNotNull()).groupBy(F.col(center).cast("double").alias("_v")).agg(
        F.min(group).alias("_g"))
    if signed:
        top = known.agg(F.max_by("_g", "_v")).scalar()
        best = points.select("_id", top.alias(f"nearest_{group}"))
    else:
        none = F.lit(None)
        line = points.select("_id", "_v", none.cast("string").alias("_g"), F.lit(1).alias("_k")).unionByName(
            known.select(none.cast(dict(df.dtypes)[key]).alias("_id"), "_v", F.col("_g").cast("string").alias("_g"), F.lit(0).alias("_k")))
        center_here = F.when(F.col("_k") == 0, F.struct(F.col("_v").alias("c"), F.col("_g").alias("g")))
        up = scan_along(line, [F.col("_v").asc(), F.col("_k").asc(), F.col("_id").asc()], {"_below": Scan("last", center_here)})
        both = scan_along(up, [F.col("_v").desc(), F.col("_k").asc(), F.col("_id").asc()], {"_above": Scan("last", center_here)})
        low = F.when(F.col("_below").isNotNull(), F.struct((F.col("_v") - F.col("_below.c")).alias("d"), F.col("_below.g").alias("g")))
        high = F.when(F.col("_above").isNotNull(), F.struct((F.col("_above.c") - F.col("_v")).alias("d"), F.col("_above.g").alias("g")))
        best = both.filter(F.col("_k") == 1).select("_id", F.least(low, high)["g"].alias(f"nearest_{group}"))
    return df.join(best, F.col(key) == F.col("_id"), "left").drop("_id")
