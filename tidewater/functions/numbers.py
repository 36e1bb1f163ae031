"""Numeric column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column | str) -> Column:
    """Exact two-place amount, so that sums do not depend on the order of addition."""
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def exact_sum(c: Column | str) -> Column:
    return F.sum(money(c)).cast("double")


def exact_mean(c: Column | str) -> Column:
    """Mean of a two-place amount through its exact sum."""
    return F.try_divide(F.sum(money(c)).cast("double"), F.count(money(c)))


def missing(c: Column) -> Column:
    """NaN becomes NULL."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def np_round(c: Column, places: int = 0) -> Column:
    """Scale, round half to even, scale back: the array-library rule for `.round()`."""
    scale = float(10**places)
    return F.rint(c * scale) / scale if places else F.rint(c)


def round_half_up(c: Column, places: int = 2) -> Column:
    """floor(x * m + 0.5) / m."""
    m = float(10**places)
    return F.floor(c * m + F.lit(0.5)).cast("double") / m


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 when b is zero or either side is missing."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def truncated_div(a: Column, b: Column) -> Column:
    """Integer quotient cut toward zero; NULL for a zero divisor."""
    return F.when(b != 0, F.call_function("div", a.cast("long"), b.cast("long")))


def century(year: Column) -> Column:
    return F.ceil(year / F.lit(100)).cast("int")


def to_24h(hour: Column, half: Column) -> Column:
    """12-hour clock plus 'am' / 'pm' to an hour 0-23."""
    base = hour % 12
    return F.when(F.lower(half) == "pm", base + 12).otherwise(base)


def first_match(*branches: tuple[Column, object], default: object = None) -> Column:
    """The value of the first true condition; NULL conditions count as false."""
    out = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(F.lit(default))


def where_set(mask: Column, value: Column, current: Column) -> Column:
    """Replace `current` by `value` on the rows of `mask`."""
    return F.when(mask, value).otherwise(current)


def joules_to_kcal(c: Column) -> Column:
    return c / F.lit(4184.0)


def circle_from_area(area: Column) -> Column:
    """pi * sqrt(d)."""
    return F.lit(3.141592653589793) * F.sqrt(area)


def row_sum(cols: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return total
