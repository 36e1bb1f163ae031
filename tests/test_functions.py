"""Edge rules of the column functions on inline rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewater.functions import arrays, dates, numbers, text


def one(spark, column, **values):
    rows = [tuple(values.values())]
    schema = ", ".join(f"{k} {t}" for k, t in ((k, _type(v)) for k, v in values.items()))
    return spark.createDataFrame(rows, schema).select(column.alias("r")).first()["r"]


def _type(v):
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "long"
    if isinstance(v, float):
        return "double"
    if isinstance(v, list):
        return f"array<{_type(v[0])}>"
    if isinstance(v, dict):
        return "map<string, double>"
    return "string"


@pytest.mark.parametrize("x,want", [(0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (-0.5, 0.0)])
def test_np_round_is_half_even(spark, x, want):
    assert one(spark, numbers.np_round(F.col("x")), x=x) == want


def test_round_half_up(spark):
    assert one(spark, numbers.round_half_up(F.col("x"), 1), x=0.25) == 0.3


def test_ratio_of_zero_and_null(spark):
    assert one(spark, numbers.safe_ratio(F.col("a"), F.lit(0)), a=3) == 0
    assert one(spark, numbers.safe_ratio(F.lit(None), F.col("a")), a=3) == 0
    assert one(spark, numbers.truncated_div(F.col("a"), F.lit(2)), a=-7) == -3
    assert one(spark, numbers.truncated_div(F.col("a"), F.lit(0)), a=-7) is None


def test_nan_becomes_null(spark):
    assert one(spark, numbers.missing(F.col("a")), a=float("nan")) is None


@pytest.mark.parametrize("year,want", [(1900, 19), (1901, 20), (2000, 20), (1, 1)])
def test_century(spark, year, want):
    assert one(spark, numbers.century(F.col("y")), y=year) == want


@pytest.mark.parametrize("h,half,want", [(12, "am", 0), (12, "pm", 12), (1, "PM", 13), (11, "am", 11)])
def test_clock(spark, h, half, want):
    assert one(spark, numbers.to_24h(F.col("h"), F.col("p")), h=h, p=half) == want


def test_first_match_takes_null_as_false(spark):
    v = F.lit(None).cast("double")
    assert one(spark, numbers.first_match((v < 1, 1), (v >= 1, 2), default=0), a=1) == 0


@pytest.mark.parametrize("pw,want", [("Abc123", True), ("abc123", False), ("ABC123", False), ("Abcdef", False), ("Abc 123", False), ("Ёжик7", True), ("Abc12!", False)])
def test_password(spark, pw, want):
    assert one(spark, text.strong_password(F.col("s")), s=pw) is want


def test_words(spark):
    c = F.col("s")
    assert one(spark, text.nth_word(c, 5, "no such"), s="a b") == "no such"
    assert one(spark, text.nth_word(c, -2), s="a b c") == "b"
    assert one(spark, text.odd_words(c), s="a b c d") == ["a", "c"]
    assert one(spark, text.strip_each_word(c, 2), s="xxHixx abc yyyoyy") == ["Hi", "", "yo"]
    assert one(spark, text.count_char(c, "@"), s="a@b@") == 2
    assert one(spark, text.shout(c), s="hi, it's me!") == "HI ITS ME"


@pytest.mark.parametrize("name,want", [("Kelly, Mr. James", "Mr"), ("Wilkes, Mrs. James (Ellen Needs)", "Mrs"), ("Nobody", None)])
def test_title(spark, name, want):
    assert one(spark, text.title_of(F.col("s")), s=name) == want


def test_prices(spark):
    assert one(spark, text.joined_digits(F.col("s")), s="Цена 649,50 руб") == 649.5
    assert one(spark, text.second_token_price(F.col("s")), s="Цена 649,50 руб") == 649.5
    assert one(spark, text.second_token_price(F.col("s")), s="Цена") is None
    assert one(spark, text.decimal_comma(F.col("s")), s="1,5") == 1.5


def test_longest_replacement(spark):
    mapping = {"посёлок": "поселок", "посёлок городского типа": "поселок"}
    c = text.replace_longest(F.col("s"), mapping)
    assert one(spark, c, s="посёлок городского типа Рощино") == "поселок Рощино"
    assert one(spark, c, s="посёлок Мурино и посёлок А") == "поселок Мурино и поселок А"
    assert one(spark, c, s="Мурино") == "Мурино"
    assert one(spark, text.replace_longest(F.col("s"), {"a": "b", "b": "a"}), s="abba") == "baab"


def test_codes_and_json(spark):
    assert one(spark, text.map_codes(F.col("s"), {"C": 0}), s="Z") == -1
    assert one(spark, text.json_field(F.col("s"), "ru", F.lit("none")), s='{"en": "x"}') == "none"
    assert one(spark, text.parse_matrix(F.col("s")), s="1 2.5\n\n3 x") == [[1.0, 2.5], [3.0, None]]


def test_bands_and_minutes(spark):
    ts = F.col("s").cast("timestamp_ntz")
    band = dates.in_clock_band(ts, "21:00:00", "01:00:00")
    for s, want in (("2024-01-01 21:00:00", True), ("2024-01-01 01:00:00", True), ("2024-01-01 01:00:01", False), ("2024-01-01 12:00:00", False)):
        assert one(spark, band, s=s) is want
    minutes = dates.minutes_between(ts, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert one(spark, minutes, s="2024-01-01 00:01:30") == -1.5
    assert len(one(spark, dates.hours_of("2024-01-01"), s="")) == 24
    assert one(spark, dates.weekday(ts), s="2024-01-01 00:00:00") == 0


def test_arrays(spark):
    a = F.col("a")
    assert one(spark, arrays.cosine(a, F.transform(a, lambda x: x * 0)), a=[1.0, 2.0]) is None
    assert one(spark, arrays.cosine(a, a), a=[3.0, 4.0]) == pytest.approx(1)
    assert one(spark, arrays.set_every(a, 3, F.lit(0.0)), a=[1.0, 2.0, 3.0, 4.0]) == [0.0, 2.0, 3.0, 0.0]
    assert one(spark, arrays.argmax(a), a=[1.0, 5.0, 5.0]) == 1
    assert one(spark, arrays.argsort(a), a=[3.0, 1.0, 2.0]) == [1, 2, 0]
    assert one(spark, arrays.reshape(a, 2), a=[1.0, 2.0, 3.0]) == [[1.0, 2.0], [3.0]]
    assert one(spark, arrays.stride(a, 1, 2), a=[1.0, 2.0, 3.0, 4.0]) == [2.0, 4.0]
    assert one(spark, arrays.close_positions(a, F.reverse(a), 1.0), a=[1.0, 5.0, 2.0]) == [1]
    assert one(spark, arrays.largest_rounding_below(a, F.lit(1.9)), a=[0.0, 1.0, 1.5, 2.0]) == 1.0
    assert one(spark, arrays.map_keys_in_range(F.col("m"), 1, 2), m={"b": 1.0, "a": 2.0, "c": 3.0}) == ["a", "b"]
