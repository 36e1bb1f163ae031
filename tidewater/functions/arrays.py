"""Column functions on arrays and maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL when a norm is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def mean(a: Column) -> Column:
    return F.try_divide(total(a), F.size(a))


def argmax(a: Column) -> Column:
    """Zero-based position of the first largest element."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("long")


def argmin(a: Column) -> Column:
    return (F.array_position(a, F.array_min(a)) - 1).cast("long")


def set_every(a: Column, step: int, value: Column) -> Column:
    """Overwrite elements 0, step, 2*step, ..."""
    return F.transform(a, lambda x, i: F.when(i % step == 0, value).otherwise(x))


def set_at(a: Column, positions: Sequence[int], value: Column) -> Column:
    return F.transform(a, lambda x, i: F.when(i.isin(*positions), value).otherwise(x))


def close_positions(a: Column, b: Column, precision: float) -> Column:
    """Zero-based positions where |a - b| < precision."""
    near = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")) < precision)
    return F.filter(F.transform(near, lambda hit, i: F.when(hit, i)), lambda i: i.isNotNull())


def elementwise_add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") + y.cast("double"))


def elementwise_less(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x < y)


def stride(a: Column, start: int, step: int) -> Column:
    """Elements start, start + step, ... (zero-based)."""
    return F.filter(a, lambda x, i: (i >= start) & ((i - start) % step == 0))


def reshape(a: Column, width: int) -> Column:
    """Cut a flat array in rows of `width`; the last row may be shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(width))
    return F.transform(starts, lambda s: F.slice(a, s, F.lit(width)))


def sort_desc(a: Column) -> Column:
    return F.sort_array(a, asc=False)


def argsort(a: Column) -> Column:
    """Zero-based positions in ascending order of value (position breaks ties)."""
    tagged = F.transform(a, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.transform(F.array_sort(tagged), lambda s: s["i"])


def largest_rounding_below(a: Column, n: Column) -> Column:
    """Largest element whose half-even rounded form is <= n."""
    return F.array_max(F.filter(a, lambda x: F.rint(x) <= n))


def largest_rounding_above(a: Column, n: Column) -> Column:
    """Largest element whose half-even rounded form is >= n."""
    return F.array_max(F.filter(a, lambda x: F.rint(x) >= n))


def map_keys_in_range(m: Column, low: float, high: float) -> Column:
    """Sorted keys whose value lies in [low, high]."""
    return F.sort_array(F.map_keys(F.map_filter(m, lambda k, v: v.between(low, high))))


def pick_names_by_score(names: Column, scores: Column, above: float) -> tuple[Column, Column]:
    """Split `names` in two arrays by whether the score at the same position is above a limit."""
    pairs = F.zip_with(names, scores, lambda n, s: F.struct(n.alias("n"), s.alias("s")))

    def keep(cond):
        return F.transform(F.filter(pairs, cond), lambda p: p["n"])

    return keep(lambda p: p["s"] > above), keep(lambda p: ~(p["s"] > above))
