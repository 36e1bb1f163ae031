"""Ordered calculations: running totals, row numbers, islands, moving and weighted means, fills, smoothing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidewater.staging import Scan, frames_along, scan_along


def global_running_sum(
    df: DataFrame, order_by: Sequence[Column], value: Column, out: str,
    partition_by: Sequence[str] = (), partitions: int | None = None,
) -> DataFrame:
    """Running sum from the first row to the current one."""
    return scan_along(df, order_by, {out: Scan("sum", value)}, partition_by, partitions)


def global_row_number(
    df: DataFrame, order_by: Sequence[Column], out: str,
    partition_by: Sequence[str] = (), partitions: int | None = None,
) -> DataFrame:
    """Dense 1-based row number."""
    return scan_along(df, order_by, {out: Scan("sum", F.lit(1).cast("long"))}, partition_by, partitions)


def fill_along(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], cols: Sequence[str],
    direction: str = "forward",
) -> DataFrame:
    """Fill nulls with the previous ('forward') or next ('backward') value of the same key."""
    order = [F.col(c).asc() if direction == "forward" else F.col(c).desc() for c in order_by]
    scans = {f"_f_{c}": Scan("last", F.col(c)) for c in cols}
    filled = scan_along(df, order, scans, partition_by)
    return filled.select(*[F.col(f"_f_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def previous_row(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], value: Column, out: str
) -> DataFrame:
    """Value of the row before, NULL on the first."""
    return scan_along(df, order_by, {out: Scan("lag", value)}, partition_by)


def islands(df: DataFrame, date_col: str, unit: str = "month") -> DataFrame:
    """Add `island_id`: rows of neighbouring months (or days) share it.

    The distinct months are counted first, so the ordered window covers a calendar, not the facts.
    """
    calendar = df.select(F.trunc(date_col, unit).alias("_p") if unit == "month" else F.to_date(date_col).alias("_p"))
    calendar = calendar.filter(F.col("_p").isNotNull()).distinct()
    rn = F.row_number().over(Window.orderBy("_p"))
    shift = F.add_months("_p", -rn) if unit == "month" else F.date_sub("_p", rn)
    ids = calendar.select("_p", shift.alias("island_id"))
    key = F.trunc(date_col, unit) if unit == "month" else F.to_date(date_col)
    return df.withColumn("_k", key).join(ids, F.col("_k") == F.col("_p"), "left").drop("_k", "_p")


def moving_mean(
    df: DataFrame, order_by: Sequence[str], value: Column, rows: int, out: str,
    partition_by: Sequence[str] = (), partitions: int | None = None,
) -> DataFrame:
    """Mean over the current and the previous rows of the key."""
    reach = lambda w: w.rowsBetween(-(rows - 1), 0)
    return frames_along(df, [F.col(c) for c in order_by], {out: lambda w: F.avg(value).over(reach(w))}, rows - 1, 0, partition_by, partitions)


def frame_count(
    df: DataFrame, order_by: Sequence[str], rows: int, out: str, partition_by: Sequence[str] = (), partitions: int | None = None,
) -> DataFrame:
    """How many rows the frame of the current and the previous rows has."""
    reach = lambda w: w.rowsBetween(-(rows - 1), 0)
    return frames_along(df, [F.col(c) for c in order_by], {out: lambda w: F.count(F.lit(1)).over(reach(w))}, rows - 1, 0, partition_by, partitions)


def weighted_ma(
    df: DataFrame, order_by: Sequence[str], value: str, weights: Sequence[int], impl: str = "lag", out: str = "weighted_ma",
    partition_by: Sequence[str] = (), partitions: int | None = None,
) -> DataFrame:
    """Weighted mean over the latest rows of the key, weights[0] on the current one.

    The denominator is the sum of the weights that have a row. `impl` takes the earlier rows one by one ("lag")
    or as an array ("array"); both see them through sliding frames of slices, so a series may be a whole fact table.
    """
    back = len(weights) - 1

    def by_lags(w: WindowSpec) -> Column:
        top = F.lit(0.0)
        for i, weight in enumerate(weights):
            top = top + (F.lag(value, i, 0.0).over(w) if i else F.col(value)) * weight
        seen = F.count(F.lit(1)).over(w.rowsBetween(-back, 0)).cast("int")
        return top / F.get(F.array(*[F.lit(sum(weights[: i + 1])) for i in range(len(weights))]), seen - 1)

    if impl not in ("lag", "array"):
        raise ValueError("impl is 'lag' or 'array'")
    order = [F.col(c) for c in order_by]
    if impl == "lag":
        return frames_along(df, order, {out: by_lags}, back, 0, partition_by, partitions)
    recent = frames_along(df, order, {"_recent": lambda w: F.reverse(F.collect_list(F.col(value)).over(w.rowsBetween(-back, 0)))}, back, 0, partition_by, partitions)
    facing = F.slice(F.array(*[F.lit(float(x)) for x in weights]), 1, F.size("_recent"))
    pairs = F.zip_with("_recent", facing, lambda v, x: F.struct((v * x).alias("vx"), x.alias("x")))
    top = F.aggregate("_pairs", F.lit(0.0), lambda acc, p: acc + p["vx"])
    bottom = F.aggregate("_pairs", F.lit(0.0), lambda acc, p: acc + p["x"])
    return recent.withColumn("_pairs", pairs).withColumn(out, top / bottom).drop("_recent", "_pairs")


def with_group_value(df: DataFrame, keys: Sequence[str], bounded: bool = False, **aggs: Column) -> DataFrame:
    """Put group aggregates beside every row.

    An aggregate joined back: it combines on the map side, so a key that holds a third of the rows
    never has to fit in one task. `bounded` says that a group can't grow with the table (the lines of
    one order): then a window does it with one shuffle.
    """
    if bounded:
        w = Window.partitionBy(*keys)
        return df.select("*", *[c.over(w).alias(o) for o, c in aggs.items()])
    per_key = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(*[c.alias(o) for o, c in aggs.items()])
    on = None
    for k in keys:
        cond = F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        on = cond if on is None else on & cond
    return df.join(per_key, on, "left").drop(*[f"_g_{k}" for k in keys])


def first_row_marker(df: DataFrame, key: str, text: str, out: str = "comment") -> DataFrame:
    """`text` on the row with the smallest key, NULL elsewhere."""
    least = df.agg(F.min(key)).scalar()
    return df.withColumn(out, F.when(F.col(key) == least, F.lit(text)))


def run_until_break(df: DataFrame, partition_by: Sequence[str], order_by: str, text: str) -> DataFrame:
    """Per key: rows before the first one that breaks the chain rule.

    A row keeps the chain when its text starts with the last letter of the previous text and is
    one character longer. Output: keys and `run_length` (all rows when nothing breaks).
    """
    seen = scan_along(
        df, [F.col(order_by).asc()],
        {"_prev": Scan("lag", F.col(text)), "_rn": Scan("sum", F.lit(1).cast("long"))}, partition_by)
    fits = (F.left(text, F.lit(1)) == F.right("_prev", F.lit(1))) & (
        F.length(text) == F.length("_prev") + 1)
    broken = F.col("_prev").isNotNull() & ~F.coalesce(fits, F.lit(False))
    return seen.groupBy(*partition_by).agg(
        F.coalesce(F.min(F.when(broken, F.col("_rn"))) - 1, F.max("_rn")).alias("run_length"))


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
    return [x / sum(raw) for x in raw]


def gaussian_smooth(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], value: str, sigma: float,
    out: str = "smooth", chunk: int = 4096,
) -> DataFrame:
    """Gaussian filter along each series, edges mirrored (d c b a | a b c d | d c b a).

    Every series is numbered, cut in chunks of `chunk` rows, and the rows near a chunk border are
    copied to the neighbour, so the weights are applied inside small groups however long a series is.
    """
    weights = gaussian_weights(sigma)
    radius = len(weights) // 2
    keys = list(partition_by)
    numbered = global_row_number(df, [F.col(c).asc() for c in order_by], "_rn", keys)
    sized = with_group_value(numbered, keys, _n=F.count(F.lit(1))) if keys else numbered.withColumn(
        "_n", numbered.agg(F.count(F.lit(1))).scalar())
    # Positions outside 1..n repeat the series mirrored, with period 2n.
    turn = 2 * F.col("_n")
    reach = F.ceil(F.lit(float(radius)) / turn).cast("long") + 1
    turns = F.sequence(-reach, reach)
    images = F.array_union(
        F.transform(turns, lambda k: F.col("_rn") + turn * k),
        F.transform(turns, lambda k: 1 - F.col("_rn") + turn * k),
    )
    near_edge = (F.col("_rn") <= radius) | (F.col("_rn") > F.col("_n") - radius)
    places = F.when(
        near_edge, F.filter(images, lambda p: (p >= 1 - radius) & (p <= F.col("_n") + radius))
    ).otherwise(F.array(F.col("_rn")))
    placed = sized.withColumn("_p", F.explode(places))
    # The chunks that need position p are those of p - radius .. p + radius.
    first = F.floor((F.col("_p") - radius - 1) / chunk).cast("long")
    last = F.floor((F.col("_p") + radius - 1) / chunk).cast("long")
    spread = placed.withColumn("_chunk", F.explode(F.sequence(first, last)))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_p")
    smooth = F.lit(0.0)
    for i, weight in enumerate(weights):
        step = i - radius
        neighbour = F.col(value) if step == 0 else (
            F.lead(value, step).over(w) if step > 0 else F.lag(value, -step).over(w))
        smooth = smooth + neighbour * weight
    own = (F.col("_p") == F.col("_rn")) & (F.floor((F.col("_p") - 1) / chunk) == F.col("_chunk"))
    return spread.select(*df.columns, smooth.alias(out), own.alias("_own")).filter("_own").drop("_own")
