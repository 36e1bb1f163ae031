"""Exact order statistics by rounds of narrowing.

The rows of a group are held as cells: disjoint stretches of the sorted values with their counts, one cell per value
where a wanted rank can lie and one per gap elsewhere. The first round takes its borders from a sketch with
known rank error. Further rounds cut the cells of a group at evenly spread splitters, count the buckets, keep
the cells of those that hold a wanted rank and merge the rest, until no group has more cells than a fixed
number. Counts combine before every shuffle, a value that fills a third of the table is one cell, and what
is put in order in the end is bounded whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.functions.numbers import missing
from tidewater.staging import stage

#: Cells that a group may have when its ranks are read off.
CELLS = 20_000
#: The sketch's relative rank error is 1 / ACCURACY; smaller groups keep all their values as cells.
ACCURACY = 10_000


def _counted(cells: DataFrame) -> tuple[DataFrame, int]:
    """The cells as a staged table, and their number, counted as they were written."""
    seen = Observation()
    table = stage(cells.observe(seen, F.count(F.lit(1)).alias("cells")))
    return table, seen.get.get("cells", 0)


def _ranks(n: Column, probs: Sequence[float]) -> Column:
    """The ranks (from 0) on both sides of each quantile of n values."""
    lower = [F.floor((n.cast("double") - 1.0) * p).cast("long") for p in probs]
    return F.array(*[r for k in lower for r in (k, F.least(k + 1, n - 1))])


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(i).eqNullSafe(F.col(j)) for i, j in zip(a, b)])


def _with_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Group values beside rows. The staged `groups` are broadcast when the planner sees that they are small."""
    if not keys:  # one row of values: a scalar subquery
        one = groups.agg(F.first(F.struct(*groups.columns)).alias("s")).scalar()
        return rows.withColumn("_one", one).select(*rows.columns, "_one.*")
    other = [f"_g{k}" for k in keys]
    return rows.join(groups.withColumnsRenamed(dict(zip(keys, other))), _same(keys, other), how).drop(*other)


def _first_cells(src: DataFrame, keys: Sequence[str], probs: Sequence[float], accuracy: int) -> DataFrame | None:
    margin = 4.0 / accuracy
    edges = [p for q in sorted(probs) for p in (max(0.0, q - margin), min(1.0, q + margin))]
    summary = src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.percentile_approx("_v", edges, accuracy).alias("_at"))
    # The outermost ranks lie at the extremes; of a small group every value becomes a cell.
    lows = F.array(*[F.when((F.col("_n") <= accuracy) | F.lit(p <= 0.0), F.col("_lo")).otherwise(F.get("_at", F.lit(2 * i))) for i, p in enumerate(edges[::2])])
    highs = F.array(*[F.when((F.col("_n") <= accuracy) | F.lit(p >= 1.0), F.col("_hi")).otherwise(F.get("_at", F.lit(2 * i + 1))) for i, p in enumerate(edges[1::2])])
    brackets = summary.select(*keys, lows.alias("_low"), highs.alias("_high"))
    if keys:
        tagged = _with_groups(src, stage(brackets), keys)
        low, high = F.col("_low"), F.col("_high")
    else:
        row = brackets.head()
        if row["_low"][0] is None:
            return None
        kind = src.schema["_v"].dataType
        tagged, low, high = src, *(F.array(*[F.lit(x).cast(kind) for x in row[c]]) for c in ("_low", "_high"))
    pairs = range(len(probs))
    inside = reduce(lambda a, b: a | b, [F.col("_v").between(low[i], high[i]) for i in pairs])
    gap = reduce(lambda a, b: a + b, [(F.col("_v") > high[i]).cast("int") for i in pairs])
    return tagged.groupBy(*keys, gap.alias("_gap"), F.when(inside, F.col("_v")).alias("_in")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_rep"), F.max("_v").alias("_top")).drop("_gap", "_in")


def _narrowed(cells: DataFrame, keys: Sequence[str], probs: Sequence[float], most: int, fan: int) -> DataFrame:
    """The cells after one round: groups of more than `most` keep those of the buckets that hold a wanted rank."""
    marks = [i / fan for i in range(1, fan)]
    wide = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"), F.sum("_c").alias("_n"), F.percentile_approx("_rep", marks, 10 * fan).alias("_marks"))
    wide = stage(wide.filter(F.col("_m") > most).drop("_m"))
    dealt = _with_groups(cells, wide, keys, "left").withColumn(
        "_bucket", F.when(F.col("_n").isNotNull(), F.size(F.filter("_marks", lambda s: s < F.col("_rep")))))
    dealt = stage(dealt.drop("_marks"))
    counts = dealt.filter("_n IS NOT NULL").groupBy(*keys, "_bucket").agg(F.sum("_c").alias("_c"), F.max("_n").alias("_n"))
    per = counts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_bucket", "_c"))).alias("_b"), F.max("_n").alias("_n"))
    start = F.struct(F.lit(0).cast("long").alias("cum"), F.array().cast("array<int>").alias("kept"))
    found = F.aggregate("_b", start, lambda acc, x: F.struct(
        (acc["cum"] + x["_c"]).alias("cum"),
        F.when(F.exists("_ranks", lambda r: (r >= acc["cum"]) & (r < acc["cum"] + x["_c"])), F.array_append(acc["kept"], x["_bucket"]))
        .otherwise(acc["kept"]).alias("kept")))
    kept = stage(per.withColumn("_ranks", _ranks(F.col("_n"), probs)).select(*keys, found["kept"].alias("_kept")))
    stays = F.col("_kept").isNull() | F.array_contains("_kept", F.col("_bucket"))
    return _with_groups(dealt.drop("_n"), kept, keys, "left").groupBy(*keys, "_bucket", F.when(stays, F.col("_rep")).alias("_own")).agg(
        F.sum("_c").alias("_c"), F.min("_rep").alias("_rep"), F.max("_top").alias("_top")).drop("_bucket", "_own")


def few_valued(df: DataFrame, cols: Sequence[str], most: int = CELLS) -> set[str]:
    """The columns that have fewer than about half of `most` different values, from one pass over all of them."""
    if not cols:
        return set()
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    return {c for c in cols if row[c] <= most // 2}


def exact_quantiles(df: DataFrame, col: str, qs: Mapping[str, float], by: Sequence[str] = (),
                    accuracy: int = ACCURACY, most: int = CELLS, fan: int | None = None, counted: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation, one output column per entry of `qs`; nulls and NaN don't count.

    `most` bounds the cells of a group when its ranks are read off, `fan` is the number of buckets of a round. `counted` makes
    every value a cell at once, without a sketch: one pass, meant for columns of few values. Results don't depend on any
    of them. Without values, an ungrouped call gives one row of nulls.
    """
    names, probs = list(qs), list(qs.values())
    fan = fan or 64 + 16 * len(probs)
    keys = [f"_k{i}" for i in range(len(by))]
    src = df.select(*[F.col(k).alias(o) for k, o in zip(by, keys)], missing(F.col(col)).alias("_v")).filter(F.col("_v").isNotNull())
    if counted:
        cells = src.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).select(*keys, "_c", F.col("_v").alias("_rep"), F.col("_v").alias("_top"))
    else:
        cells = _first_cells(src, keys, probs, accuracy)
    if cells is None:
        return src.agg(*[F.max(F.col("_v").cast("double")).alias(n) for n in names])
    cells, size = _counted(cells)
    while size > most and (not keys or not cells.groupBy(*keys).count().filter(F.col("count") > most).isEmpty()):
        before = size
        cells, size = _counted(_narrowed(cells, keys, probs, most, fan))
        if size >= before:
            break
    per = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_rep", "_top", "_c"))).alias("_cells"), F.sum("_c").alias("_n"))
    per = per.withColumn("_ranks", _ranks(F.col("_n"), probs))
    kind = src.schema["_v"].dataType

    def value(r: Column, cum: Column, x: Column) -> Column:
        # A rank at either end of a gap is known; one inside would mean that the sketch broke its bound.
        return (F.when((r < cum) | (r >= cum + x["_c"]), F.lit(None).cast(kind)).when((r == cum) | (x["_rep"] == x["_top"]), x["_rep"])
                .when(r == cum + x["_c"] - 1, x["_top"]).otherwise(F.raise_error(F.lit("a rank fell outside its bracket")).cast(kind)))

    start = F.struct(F.lit(0).cast("long").alias("cum"), F.transform("_ranks", lambda r: F.lit(None).cast(kind)).alias("found"))
    read = F.aggregate("_cells", start, lambda acc, x: F.struct(
        (acc["cum"] + x["_c"]).alias("cum"),
        F.zip_with("_ranks", acc["found"], lambda r, v: F.coalesce(v, value(r, acc["cum"], x))).alias("found")), lambda acc: acc["found"])
    per = per.select(*[F.col(o).alias(k) for k, o in zip(by, keys)], "_n", read.alias("_found"))
    out = []
    for i, (name, p) in enumerate(qs.items()):
        low, high, pos = F.get("_found", F.lit(2 * i)), F.get("_found", F.lit(2 * i + 1)), (F.col("_n").cast("double") - 1.0) * p
        out.append((low + (high - low) * (pos - F.floor(pos))).alias(name))
    return per.select(*by, *out)


def quantile_numbers(df: DataFrame, col: str, qs: Mapping[str, float], counted: bool = False) -> dict[str, float | None]:
    """Exact quantiles as numbers on the driver (thresholds)."""
    row = exact_quantiles(df, col, qs, counted=counted).first()
    return {n: row[n] if row is not None else None for n in qs}
