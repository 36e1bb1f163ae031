"""Column functions on text."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII punctuation set.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words(c: Column) -> Column:
    """Whitespace-separated words, without empty ones."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def nth_word(c: Column, n: int, missing: str | None = None) -> Column:
    """Zero-based word, negative from the end; `missing` when out of range."""
    w = words(c)
    found = F.get(w, F.lit(n)) if n >= 0 else F.get(w, F.size(w) + n)
    return F.coalesce(found, F.lit(missing)) if missing is not None else found


def odd_words(c: Column) -> Column:
    """First, third, fifth ... word."""
    return F.filter(words(c), lambda w, i: i % 2 == 0)


def even_words(c: Column) -> Column:
    return F.filter(words(c), lambda w, i: i % 2 == 1)


def strip_each_word(c: Column, n: int) -> Column:
    """Cut n characters from both ends of every word."""
    return F.transform(words(c), lambda w: F.substring(w, F.lit(n + 1), F.greatest(F.length(w) - 2 * n, F.lit(0))))


def count_char(c: Column, char: str) -> Column:
    return F.regexp_count(c, F.lit(re.escape(char))).cast("long")


def strong_password(c: Column) -> Column:
    """Only letters and digits, with at least one upper, one lower and one digit."""
    return (
        c.rlike(r"^[\p{L}\p{N}]+$") & c.rlike(r"\p{Lu}") & c.rlike(r"\p{Ll}") & c.rlike(r"\p{Nd}")
    )


def shout(c: Column) -> Column:
    """Drop ASCII punctuation, then upper-case."""
    return F.upper(F.translate(c, PUNCTUATION, ""))


def title_of(c: Column) -> Column:
    """Honorific in a full name, such as Mr in 'Kelly, Mr. James'; NULL when absent."""
    return F.nullif(F.regexp_extract(c, r" ([A-Za-z]+)\.", 1), F.lit(""))


def joined_digits(c: Column) -> Column:
    """All digit runs joined by a dot, read as a number ('1 234,50' is not read as thousands)."""
    runs = F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1))
    return F.array_join(runs, ".").try_cast("double")


def second_token_price(c: Column) -> Column:
    """Second blank-separated token with a decimal comma."""
    return F.replace(F.get(F.split(c, " "), F.lit(1)), F.lit(","), F.lit(".")).try_cast("double")


def decimal_comma(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def replace_longest(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace every key by its value in one pass, the longest key winning where several start.

    Keys are literal text. Each hit is cut out by one alternation, so a replacement is never
    replaced again.
    """
    keys = sorted(mapping, key=len, reverse=True)
    pattern = "|".join(re.escape(k) for k in keys)
    hits = F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(c, pattern, -1)
    table = F.create_map(*[F.lit(x) for k in keys for x in (k, mapping[k])])
    pieces = F.zip_with(gaps, hits, lambda g, h: F.concat(g, F.coalesce(table[h], F.lit(""))))
    return F.array_join(pieces, "")


def map_codes(c: Column, mapping: Mapping, default=-1) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(table, c), F.lit(default))


def contains_either(a: Column, b: Column, needle: str) -> Column:
    return F.coalesce(a.contains(needle), F.lit(False)) | F.coalesce(b.contains(needle), F.lit(False))


def parse_matrix(c: Column, row_sep: str = "\n", cell_sep: str = " ") -> Column:
    """Text to an array of arrays of doubles; cells that are not numbers become NULL."""
    rows = F.filter(F.split(c, re.escape(row_sep)), lambda r: F.trim(r) != "")
    return F.transform(rows, lambda r: F.transform(
        F.filter(F.split(r, re.escape(cell_sep)), lambda x: x != ""), lambda x: x.try_cast("double")))


def json_field(c: Column, field: str, default: Column | None = None) -> Column:
    got = F.get_json_object(c, f"$.{field}")
    return F.coalesce(got, default) if default is not None else got
