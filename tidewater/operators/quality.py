"""Missing values, outliers and repair."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import missing, np_round
from tidewater.operators.ranges import nearest_group
from tidewater.operators.stats import exact_quantiles, quantile_numbers
from tidewater.staging import stage


def _is_missing(df: DataFrame, c: str) -> Column:
    kind = dict(df.dtypes)[c]
    return F.col(c).isNull() | F.isnan(c) if kind in ("double", "float") else F.col(c).isNull()


def null_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Null count and percentage (one place) per column, worst first."""
    one = df.agg(
        F.count(F.lit(1)).alias("_n"),
        F.array(*[F.struct(F.lit(c).alias("column"), F.count_if(_is_missing(df, c)).alias("nulls")) for c in df.columns]).alias("_s"))
    rows = one.select("_n", F.explode("_s").alias("s")).select(
        "s.column", "s.nulls", np_round(F.try_divide(F.col("s.nulls") * 100.0, F.col("_n")), 1).alias("pct"))
    rows = rows.filter("nulls > 0") if only_missing else rows
    return rows.orderBy(F.col("nulls").desc(), "column")


def null_map(df: DataFrame, bucket: Column, cols: Sequence[str]) -> DataFrame:
    """Share of missing values per row bucket and column."""
    rates = df.groupBy(bucket.alias("bucket")).agg(*[
        F.avg(_is_missing(df, c).cast("double")).alias(c) for c in cols])
    return rates.unpivot("bucket", list(cols), "column", "null_rate")


def conditional_nulls(df: DataFrame, a: str, b: str) -> DataFrame:
    """Nulls of b where a > 0, a = 0 and a is null, and nulls of b in all."""
    gone = _is_missing(df, b)
    return df.agg(
        F.count_if((F.col(a) > 0) & gone).alias("when_positive"), F.count_if((F.col(a) == 0) & gone).alias("when_zero"),
        F.count_if(_is_missing(df, a) & gone).alias("when_null"), F.count_if(gone).alias("total"))


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop every column that has a null; one row of flags comes to the driver."""
    flags = df.agg(*[F.max(_is_missing(df, c)).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if flags[c]])


def fill_by_type(df: DataFrame, text: str = "", number: float = 0) -> DataFrame:
    """Strings get `text`, numbers get `number`."""
    return df.fillna(text).fillna(number)


def fill_stats(df: DataFrame, stats: Mapping[str, str], scale: int | None = None) -> DataFrame:
    """Fill each column with its mean, median, min or max.

    All means and extremes come from one aggregation over the rows as they were. The values become
    literals: later steps then see the same bits wherever the plan is evaluated again.
    """
    simple = {"mean": F.avg, "min": F.min, "max": F.max}
    plain = [simple[s](missing(F.col(c))).alias(c) for c, s in stats.items() if s != "median"]
    values = df.agg(*plain).first().asDict() if plain else {}
    for c, s in stats.items():
        if s == "median":
            values[c] = quantile_numbers(df, c, {"q": 0.5})["q"]
    def filled(c: str) -> Column:
        value = F.lit(values[c]).cast("double")
        return F.coalesce(missing(F.col(c)), np_round(value, scale) if scale is not None else value)
    return df.select(*[filled(c).alias(c) if c in values else F.col(c) for c in df.columns])


def fill_stat(df: DataFrame, col: str, stat: str, scale: int | None = None) -> DataFrame:
    """Fill one column with its mean, median, min or max."""
    return fill_stats(df, {col: stat}, scale)


def fill_group_mean(df: DataFrame, col: str, keys: Sequence[str], key_expr: Mapping[str, Column] | None = None,
                    scale: int | None = 2, global_mean: bool = True, half_even_int: bool = False,
                    global_value: Column | None = None, overall_after: bool = False) -> DataFrame:
    """Fill with the mean of the row's group (rounded to `scale`), then with the mean of the whole column.

    `key_expr` replaces a key by an expression (such as a rounded area). Rows with a missing key
    take the whole-column mean, or the mean of `global_value` where that is given (a column as it
    was before a repair). `overall_after` takes the whole-column mean after the group fill, so that
    the group means count in it. `half_even_int` rounds both means to whole numbers.
    """
    v = missing(F.col(col))
    exprs = key_expr or {}
    key_cols = {f"_k_{k}": exprs.get(k, F.col(k)) for k in keys}
    keyed = F.lit(True)
    for c in key_cols.values():
        keyed = keyed & c.isNotNull()
    places = 0 if half_even_int else scale
    mean = F.avg(v) if places is None else np_round(F.avg(v), places)
    means = df.filter(keyed & v.isNotNull()).groupBy(*[c.alias(n) for n, c in key_cols.items()]).agg(mean.alias("_m"))
    # Only the rows with a gap meet the group means; the others are passed on without a shuffle.
    gaps = df.filter(v.isNull())
    on = None
    for n, c in key_cols.items():
        on = c == F.col(n) if on is None else on & (c == F.col(n))
    value = F.col("_m")
    if global_mean and overall_after:
        # Sums and counts of the values and of the filled gaps make the mean; no column is filled for it.
        had = df.agg(F.sum(v).alias("s"), F.count(v).alias("n"))
        got = gaps.join(means, on, "left").agg(F.sum("_m").alias("s"), F.count("_m").alias("n"))
        overall = had.unionByName(got).agg(F.try_divide(F.sum("s"), F.sum("n"))).scalar()
        value = F.coalesce(value, np_round(overall) if half_even_int else overall)
    elif global_mean:
        overall = df.agg(F.avg(v if global_value is None else missing(global_value))).scalar()
        value = F.coalesce(value, np_round(overall) if half_even_int else overall)
    filled = gaps.join(means, on, "left").select(*[value.alias(c) if c == col else F.col(c) for c in df.columns])
    whole = df.filter(v.isNotNull()).select(*[v.alias(c) if c == col else F.col(c) for c in df.columns])
    return whole.unionByName(filled)


def fill_chain(df: DataFrame, steps: Sequence[tuple[str, Sequence[str]]], scale: int = 2) -> DataFrame:
    """Group-mean fills one after another; a column filled by one step may be a key of the next.

    Each step is staged: its result is read several times by the next, and a mean that is
    recomputed could differ in its last bit and then no longer match as a key.
    """
    for col, keys in steps:
        df = stage(fill_group_mean(df, col, keys, scale=scale))
    return df


def fill_ratio(df: DataFrame, target: str, whole: str, part: str, legacy: bool = False,
               places: int | None = None) -> DataFrame:
    """Fill `target` with (whole - part) * m, m being the median of target / (whole - part), rounded to `places`.

    `legacy=True` multiplies only `part`: whole - part * m.
    """
    rest = F.col(whole) - F.col(part)
    ratio = df.select(F.try_divide(F.col(target), rest).alias("r"))
    m = F.lit(quantile_numbers(ratio, "r", {"q": 0.5})["q"]).cast("double")
    m = m if places is None else np_round(m, places)
    value = F.col(whole) - F.col(part) * m if legacy else rest * m
    return df.withColumn(target, F.coalesce(missing(F.col(target)), value))


def fill_when(df: DataFrame, col: str, condition: Column, value) -> DataFrame:
    """Fill only the missing values of rows that meet the condition; NULL conditions do not."""
    return df.withColumn(col, F.when(F.col(col).isNull() & condition, F.lit(value)).otherwise(F.col(col)))


def fill_flag(df: DataFrame, col: str, legacy: bool = False) -> DataFrame:
    """Missing flags become false (`legacy=True`: true)."""
    return df.withColumn(col, F.coalesce(F.col(col).cast("boolean"), F.lit(legacy)))


def fill_nearest_group(df: DataFrame, key: str, target: str, value: str, signed: bool = False) -> DataFrame:
    """Fill a missing group label with the group whose mean `value` is nearest to the row's value."""
    centers = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.avg(missing(F.col(value))).alias("_center"))
    lacking = df.filter(F.col(target).isNull())
    found = nearest_group(lacking, centers, value, target, "_center", key, signed).select(
        F.col(key).alias("_fid"), F.col(f"nearest_{target}").alias("_near"))
    return df.join(found, F.col(key) == F.col("_fid"), "left").withColumn(
        target, F.coalesce(target, "_near")).select(*df.columns)


def trim_quantile(df: DataFrame, col: str, q: float, counted: bool = False) -> DataFrame:
    """Keep rows at or below the quantile; the threshold is one number, so it reaches the scan. Nulls go."""
    limit = quantile_numbers(df, col, {"q": q}, counted)["q"]
    return df.filter(F.col(col) <= F.lit(limit))


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5, counted: bool = False) -> tuple[float, float]:
    row = quantile_numbers(df, col, {"a": 0.25, "b": 0.75}, counted)
    if row["a"] is None:
        return float("-inf"), float("inf")
    spread = row["b"] - row["a"]
    return row["a"] - k * spread, row["b"] + k * spread


def trim_iqr(df: DataFrame, col: str, k: float = 1.5, counted: bool = False) -> DataFrame:
    """Keep rows within k interquartile ranges of the quartiles, ends included. Nulls go."""
    low, high = iqr_bounds(df, col, k, counted)
    return df.filter(F.col(col).between(low, high))


def outside_sigma(df: DataFrame, col: str, n: float = 3.0) -> DataFrame:
    """Rows strictly outside mean +- n sample deviations."""
    v = missing(F.col(col))
    s = df.agg(F.struct(F.avg(v).alias("m"), F.stddev_samp(v).alias("d"))).scalar()
    return df.filter(F.abs(v - s["m"]) > s["d"] * n)


def outlier_report(df: DataFrame, cols: Sequence[str], log: bool = True, k: float = 1.5) -> DataFrame:
    """Per column: values strictly outside the IQR bounds, count and % of non-null (two places).

    With `log`, a column whose minimum is not negative is taken through log(1 + x) first.
    """
    src = df
    if log:
        lows = df.agg(F.struct(*[F.min(missing(F.col(c))).alias(c) for c in cols])).scalar()
        src = df.select(lows.alias("_low"), *[F.col(c) for c in cols])
        src = src.select(*[F.when(F.col(f"_low.{c}") >= 0, F.log1p(missing(F.col(c)))).otherwise(missing(F.col(c))).alias(c) for c in cols])
    long = src.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), missing(F.col(c)).alias("v")) for c in cols])).alias("s")).select("s.*").filter("v IS NOT NULL")
    bounds = exact_quantiles(long, "v", {"a": 0.25, "b": 0.75}, by=["column"])
    spread = F.col("b") - F.col("a")
    marked = long.join(F.broadcast(bounds), "column").withColumn(
        "_out", (F.col("v") < F.col("a") - spread * k) | (F.col("v") > F.col("b") + spread * k))
    return marked.groupBy("column").agg(
        F.count_if("_out").alias("outliers"),
        np_round(F.count_if("_out") * 100.0 / F.count(F.lit(1)), 2).alias("pct"))


def repair_height(c: Column, variant: str = "tenth") -> Column:
    """Ceiling heights typed in the wrong unit.

    'tenth': above 10 is divided by 10. 'steps': above 11 loses 10, above 20 is divided by 10 and
    above 100 by 100, both rounded to two places.
    """
    if variant == "tenth":
        return F.when(c > 10, c / 10).otherwise(c)
    return F.when(c > 100, np_round(c / 100, 2)).when(c > 20, np_round(c / 10, 2)).when(c > 11, c - 10).otherwise(c)


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts around a repair."""
    n, m = before.agg(F.count(F.lit(1))).scalar(), after.agg(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(n.alias("rows_before"), m.alias("rows_after"))
