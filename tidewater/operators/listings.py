"""Flat advertisements: cleaning, price features and the fair price."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import exact_mean, missing, np_round
from tidewater.functions.text import replace_longest
from tidewater.operators import features, quality, selection
from tidewater.staging import stage

# Spellings of one kind of settlement.
SETTLEMENT_NAMES = {
    "посёлок": "поселок",
    "посёлок городского типа": "поселок",
    "поселок городского типа": "поселок",
    "городской поселок": "поселок",
    "городской посёлок": "поселок",
    "поселок при железнодорожной станции": "поселок",
    "посёлок при железнодорожной станции": "поселок",
    "поселок станции": "поселок",
    "посёлок станции": "поселок",
}

# Bin edges and labels of the price ranges.
INF = float("inf")
RANGES = {
    "center_distance": ([0, 1000, 3000, 5000, 10000, 20000, INF], ["0-1km", "1-3km", "3-5km", "5-10km", "10-20km", "20+km"]),
    "park_distance": ([0, 100, 500, 1000, 2000, INF], ["0-100", "101-500", "501-1000", "1001-2000", "2000+"]),
    "floor": ([0, 1, 5, 10, 20, INF], ["1", "2-5", "6-10", "11-20", "21+"]),
    "living_area": ([0, 20, 40, 60, 80, 120, INF], ["0-20", "21-40", "41-60", "61-80", "81-120", "121+"]),
    "total_area": ([0, 30, 50, 70, 90, 150, INF], ["0-30", "31-50", "51-70", "71-90", "91-150", "151+"]),
    "ceiling_height": ([0, 2.5, 2.8, 3, 3.5, 4.5, INF], ["0-2.5", "2.5-2.8", "2.8-3", "3-3.5", "3.5-4.5", "4.5+"]),
}

CHAIN = ("ceiling_height", "rooms", "living_area", "total_area", "days_on_sale")


def with_time_and_price(df: DataFrame) -> DataFrame:
    """Simple fills, price per square metre, year and month label."""
    return quality.fill_flag(df.fillna(0, ["balcony"]), "is_apartment").select(
        "*", features.price_per_unit(F.col("last_price"), F.col("total_area")).alias("price_per_m2"),
        F.year("first_day").alias("year"), F.date_format("first_day", "yyyy-MM").alias("yyyy_mm"))


def with_ranges(df: DataFrame) -> DataFrame:
    """Fill the range columns from whole-table statistics and label their bins."""
    df = quality.fill_stats(df, {
        "center_distance": "max", "park_distance": "max", "floor": "min",
        "living_area": "mean", "total_area": "mean", "ceiling_height": "mean"})
    return df.select("*", *[
        features.cut(F.col(c), [float(e) for e in edges], labels).alias(f"{c}_range") for c, (edges, labels) in RANGES.items()])


def fill_chain(df: DataFrame, cols: Sequence[str] = CHAIN, first_key: str = "locality_name") -> DataFrame:
    """Group-mean fill of each column, keyed by the settlement and all columns filled before.

    Heights are repaired first; their whole-table mean is the one before the repair. Columns
    without a gap are passed over.
    """
    gaps = df.agg(*[F.max(missing(F.col(c)).isNull()).alias(c) for c in cols]).first()
    keys = [first_key]
    for c in cols:
        before = F.col(c)
        if c == "ceiling_height":
            df = df.withColumn("_before", before).withColumn(c, quality.repair_height(before, "steps"))
            before = F.col("_before")
        if gaps[c]:
            # Staged per step: the next one reads the result several times, and means used as keys must not be recomputed.
            df = stage(quality.fill_group_mean(df, c, keys, global_value=before))
        df = df.drop("_before")
        keys.append(c)
    return df


def fair_prices(df: DataFrame) -> DataFrame:
    """All rows with `fair_price_m2`, the mean price of comparable flats."""
    df = fill_chain(with_ranges(stage(with_time_and_price(df))))
    return features.fair_value(df, "price_per_m2", ["locality_name", "rooms", *[f"{c}_range" for c in RANGES]], "fair_price_m2")


def yearly_prices(priced: DataFrame) -> DataFrame:
    return priced.groupBy("year").agg(F.avg("price_per_m2").alias("price_per_m2"), F.avg("fair_price_m2").alias("fair_price_m2"))


# How each column is trimmed in the three variants: an upper quantile, an IQR factor or an upper bound.
PERCENTILE = {c: ("quantile", 0.99) for c in (
    "images", "last_price", "total_area", "rooms", "ceiling_height", "floors_total", "living_area")}
IQR = {
    **{c: ("iqr", 1.5) for c in ("images", "total_area", "rooms", "ceiling_height", "living_area", "floor", "balcony", "kitchen_area", "days_on_sale")},
    **{c: ("quantile", 0.99) for c in ("last_price", "floors_total", "price_per_m2")},
}
MIXED = {**IQR, "images": ("quantile", 0.99), "total_area": ("below", 350)}


def clean(df: DataFrame, trims: Mapping[str, tuple[str, float]], skip_years: Sequence[int] = (), flagged: bool = True) -> DataFrame:
    """Clean listings column by column; each threshold is taken from the rows the steps before have left.

    `flagged=False` drops is_apartment instead of filling it (the variant by percentiles does).
    Thresholds and fill values are single numbers that become literals, so the plan stays flat and
    the filters reach the staged scan.
    """
    def trim(d: DataFrame, c: str) -> DataFrame:
        kind, x = trims.get(c, (None, None))
        if kind == "quantile":
            return quality.trim_quantile(d, c, x, c in few)
        if kind == "iqr":
            return quality.trim_iqr(d, c, x, c in few)
        return d.filter(F.col(c) < x) if kind == "below" else d

    df = stage(df)
    # Steps drop rows and fill by group, so a column of few values keeps few: its threshold takes one pass and no sketch.
    few = selection.few_valued(df, [c for c, (kind, _) in trims.items() if kind != "below" and c in df.columns])
    df = trim(df, "images")
    df = trim(df, "last_price").withColumn("last_price", np_round(F.col("last_price")))
    df = trim(df, "total_area").withColumn("first_day", F.date_trunc("day", "first_day").cast("timestamp_ntz"))
    df = trim(df.replace(0.0, 1.0, ["rooms"]), "rooms")
    df = df.withColumn("ceiling_height", quality.repair_height(F.col("ceiling_height")))
    height = df.agg(np_round(F.avg(missing(F.col("ceiling_height"))), 2).alias("m")).first()["m"]
    df = trim(df.withColumn("ceiling_height", F.coalesce("ceiling_height", F.lit(height))), "ceiling_height")
    df = df.dropna(subset=["floors_total"]).withColumn("floors_total", F.col("floors_total").cast("int"))
    df = trim(df, "floors_total")
    area = np_round(F.col("total_area"))
    df = quality.fill_group_mean(df, "living_area", ["area"], key_expr={"area": area}, scale=None, global_mean=False)
    df = stage(df.withColumn("living_area", F.when(area == 15, 11.0).otherwise(F.col("living_area"))))
    df = trim(df, "living_area").withColumn("living_area", np_round(F.col("living_area"), 2))
    df = trim(df, "floor")
    df = quality.fill_flag(df, "is_apartment") if flagged else df.drop("is_apartment")
    df = df.fillna(0, ["balcony"]).withColumn("balcony", F.col("balcony").cast("int"))
    df = trim(df, "balcony")
    df = trim(stage(quality.fill_ratio(df, "kitchen_area", "total_area", "living_area", places=1)), "kitchen_area")
    df = df.fillna(0, ["days_on_sale"]).withColumn("days_on_sale", F.col("days_on_sale").cast("int"))
    df = trim(df, "days_on_sale").withColumn("locality_name", replace_longest(F.col("locality_name"), SETTLEMENT_NAMES))
    df = quality.fill_when(df, "park_distance", F.col("parks_around") == 0, 3100.0)
    df = df.select(
        "*", F.year("first_day").alias("year"), F.month("first_day").alias("month"), F.weekday("first_day").alias("weekday"),
        features.price_per_unit(F.col("last_price"), F.col("total_area")).alias("price_per_m2"),
        features.floor_type(F.col("floor"), F.col("floors_total")).alias("floor_type"))
    if skip_years:
        df = df.filter(~F.col("year").isin(*skip_years))
    return trim(df, "price_per_m2")


def price_profile(df: DataFrame, rounded: Sequence[str], plain: Sequence[str], price: str) -> DataFrame:
    """(feature, x, mean_price, cnt): mean price by value of each feature, some rounded to whole numbers."""
    cells = [F.struct(F.lit(c).alias("feature"), np_round(F.col(c)).alias("x")) for c in rounded]
    cells += [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in plain]
    long = df.select(F.explode(F.array(*cells)).alias("s"), F.col(price).alias("_p")).select("s.*", "_p")
    return long.filter("x IS NOT NULL").groupBy("feature", "x").agg(exact_mean("_p").alias("mean_price"), F.count(F.lit(1)).alias("cnt"))
