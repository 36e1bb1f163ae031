"""The small tables behind plots: histograms, box numbers, counts, densities, 2-D bins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import missing
from tidewater.operators.stats import exact_quantiles


#: Bins that one row of a spine is expanded to at once.
SPINE = 65_536


def _spine(groups: DataFrame, last: Column) -> DataFrame:
    """`groups` with a row for each bin from 0 to `last`, made in stretches, so that no row holds an array as long as the spine."""
    stretches = groups.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / SPINE)))).repartition("_at")
    return stretches.withColumn("bin", F.explode(F.sequence(F.col("_at") * SPINE, F.least((F.col("_at") + 1) * SPINE - 1, last)))).drop("_at")


def _bin(v: Column, low: Column, high: Column, bins: Column) -> Column:
    """Bin number; the last bin is closed, a constant column falls in bin 0."""
    share = F.coalesce(F.try_divide(v - low, high - low), F.lit(0.0))
    return F.least(F.floor(share * bins).cast("long"), (bins - 1).cast("long"))


def histogram(df: DataFrame, col: str, bins: int | None, by: Sequence[str] = (), log_count: bool = False) -> DataFrame:
    """Counts in equal bins between the column's minimum and maximum, empty bins included.

    `bins=None` takes the number of different values + 2. With `by`, every group present gets all bins.
    """
    v = missing(F.col(col))
    count = F.lit(bins) if bins is not None else F.count_distinct(v) + 2
    s = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), count.cast("long").alias("k")))
    keys = list(by)
    src = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull()).withColumn("_s", s.scalar())
    counted = src.groupBy(*keys, _bin(F.col("_v"), F.col("_s.lo"), F.col("_s.hi"), F.col("_s.k")).alias("bin")).agg(
        F.count(F.lit(1)).alias("cnt"))
    groups = counted.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    spine = groups.withColumn("_s", s.scalar())
    last = F.col("_s.k") - 1
    spine = spine.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), last))) if bins is not None else _spine(spine, last)
    full = spine.join(counted, [*keys, "bin"], "left")
    width = (F.col("_s.hi") - F.col("_s.lo")) / F.col("_s.k")
    cnt = F.coalesce("cnt", F.lit(0).cast("long"))
    cols = [*keys, "bin", (F.col("_s.lo") + width * F.col("bin")).alias("low"),
            (F.col("_s.lo") + width * (F.col("bin") + 1)).alias("high"), cnt.alias("cnt")]
    if log_count:
        cols.append(F.when(cnt > 0, F.log10(cnt)).alias("log_cnt"))
    return full.select(*cols)


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (last values inside the bounds) and outlier count, per group."""
    keys = list(by)
    src = df.select(*keys, missing(F.col(col)).alias("_v")).filter(F.col("_v").isNotNull())
    q = exact_quantiles(src, "_v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=keys)
    if keys:
        renamed = q.select(*[F.col(x).alias(f"_q_{x}") if x in keys else F.col(x) for x in q.columns])
        on = None
        for x in keys:
            c = F.col(x).eqNullSafe(F.col(f"_q_{x}"))
            on = c if on is None else on & c
        src = src.join(renamed, on)
    else:
        src = src.withColumn("_s", q.agg(F.first(F.struct("q1", "median", "q3"))).scalar()).select("_v", "_s.*")
    spread = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - spread * k, F.col("q3") + spread * k
    fits = F.col("_v").between(low, high)
    return src.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(fits, F.col("_v"))).alias("whisker_low"), F.max(F.when(fits, F.col("_v"))).alias("whisker_high"),
        F.count_if(~fits).alias("outliers"))


def count_by(df: DataFrame, x: str, hue: str) -> DataFrame:
    return df.groupBy(x, hue).agg(F.count(F.lit(1)).alias("cnt"))


def density_grid(df: DataFrame, col: str, points: int, bandwidth: float, by: Sequence[str] = ()) -> DataFrame:
    """Gaussian kernel density on `points` equal steps between minimum and maximum.

    Equal values are merged first; every grid point is then one sum of a single map-side
    aggregation, so no row is copied.
    """
    keys = list(by)
    v = missing(F.col(col))
    size = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    low, step = size["lo"] or 0.0, ((size["hi"] or 0.0) - (size["lo"] or 0.0)) / (points - 1)
    src = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull())
    src = src.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    scale = bandwidth * math.sqrt(2 * math.pi)
    def at(i: int) -> Column:
        u = (F.lit(low + step * i) - F.col("_v")) / bandwidth
        return (F.sum(F.exp(u * u * -0.5) * F.col("_c")) / F.sum("_c") / scale).alias("density")
    grid = src.groupBy(*keys).agg(F.array(*[
        F.struct(F.lit(i).cast("long").alias("point"), F.lit(low + step * i).alias("x"), at(i)) for i in range(points)]).alias("_g"))
    return grid.select(*keys, F.explode("_g").alias("_p")).select(*keys, "_p.*")


def bins_2d(df: DataFrame, x: str, y: str, bins_x: int, bins_y: int) -> DataFrame:
    """Counts of (x bin, y bin) pairs that occur."""
    a, b = missing(F.col(x)), missing(F.col(y))
    s = df.agg(F.struct(F.min(a).alias("xl"), F.max(a).alias("xh"), F.min(b).alias("yl"), F.max(b).alias("yh"))).scalar()
    src = df.select(a.alias("_x"), b.alias("_y"), s.alias("_s")).filter("_x IS NOT NULL AND _y IS NOT NULL")
    return src.groupBy(
        _bin(F.col("_x"), F.col("_s.xl"), F.col("_s.xh"), F.lit(bins_x)).alias("x_bin"),
        _bin(F.col("_y"), F.col("_s.yl"), F.col("_s.yh"), F.lit(bins_y)).alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("cnt"))
