"""Missing-value, outlier and repair queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import np_round
from tidewater.functions.text import replace_longest
from tidewater.operators import quality
from tidewater.plans.flats import SQL, flats
from tidewater.registry import job
from tidewater.staging import stage
from tidewater.tables import Tables

WITH = f"WITH {SQL} "
_CHECKED = ("ceiling_height", "floors_total", "living_area", "balcony", "locality_name", "last_price")


@job("dq01_null_profile", WITH + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, round_even((count(*) - count({c})) * 100.0::DOUBLE / count(*) * 10, 0) / 10 AS pct FROM flats" for c in _CHECKED) + ") WHERE nulls > 0")
def null_profile(t: Tables) -> DataFrame:
    return quality.null_profile(flats(t, *_CHECKED))


@job("dq02_null_map", WITH + " UNION ALL ".join(
    f"SELECT CAST(year(first_day) AS BIGINT) AS bucket, '{c}' AS \"column\", round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 8) AS null_rate FROM flats GROUP BY 1" for c in ("balcony", "floor")))
def null_map(t: Tables) -> DataFrame:
    got = quality.null_map(flats(t, "first_day", "balcony", "floor"), F.year("first_day").cast("long"), ["balcony", "floor"])
    return got.select("bucket", "column", F.round("null_rate", 8).alias("null_rate"))


@job("dq03_conditional_nulls", WITH + """
    SELECT count(*) FILTER (WHERE parks_around > 0 AND park_distance IS NULL) AS when_positive, count(*) FILTER (WHERE parks_around = 0 AND park_distance IS NULL) AS when_zero,
           count(*) FILTER (WHERE parks_around IS NULL AND park_distance IS NULL) AS when_null, count(*) FILTER (WHERE park_distance IS NULL) AS total FROM flats
""")
def conditional_nulls(t: Tables) -> DataFrame:
    return quality.conditional_nulls(flats(t, "parks_around", "park_distance"), "parks_around", "park_distance")


@job("dq04_drop_rows_with_nulls", WITH + "SELECT line_key, floors_total, floor FROM flats WHERE floors_total IS NOT NULL AND floor IS NOT NULL")
def drop_rows(t: Tables) -> DataFrame:
    return flats(t, "line_key", "floors_total", "floor").dropna(subset=["floors_total", "floor"])


@job("dq05_drop_columns_with_nulls", WITH + "SELECT line_key, last_price, rooms FROM flats")
def drop_columns(t: Tables) -> DataFrame:
    return quality.drop_null_columns(flats(t, "line_key", "last_price", "rooms", "balcony", "locality_name"))


@job("dq06_fill_by_type", WITH + "SELECT line_key, coalesce(balcony, 0) AS balcony, coalesce(floor, 0) AS floor, coalesce(locality_name, '') AS locality_name FROM flats")
def fill_by_type(t: Tables) -> DataFrame:
    return quality.fill_by_type(flats(t, "line_key", "balcony", "floor", "locality_name"))


@job("dq07_fill_with_statistics", WITH + """
    , s AS (SELECT round_even(avg(living_area) * 100, 0) / 100 AS m, median(kitchen_area) AS k, max(center_distance) AS c, min(floor) AS f FROM flats)
    SELECT line_key, coalesce(living_area, m) AS living_area, round(coalesce(kitchen_area, k), 6) AS kitchen_area, coalesce(center_distance, c) AS center_distance, coalesce(floor, f) AS floor FROM flats, s
""")
def fill_with_statistics(t: Tables) -> DataFrame:
    df = flats(t, "line_key", "living_area", "kitchen_area", "center_distance", "floor")
    df = quality.fill_stats(df, {"kitchen_area": "median", "center_distance": "max", "floor": "min"})
    df = quality.fill_stat(df, "living_area", "mean", scale=2)
    return df.withColumn("kitchen_area", F.round("kitchen_area", 6))


@job("dq08_fill_group_mean", WITH + """
    , g AS (SELECT locality_name AS k, round_even(avg(ceiling_height) * 100, 0) / 100 AS m FROM flats WHERE locality_name IS NOT NULL GROUP BY 1),
    a AS (SELECT avg(ceiling_height) AS m FROM flats)
    SELECT line_key, round(coalesce(ceiling_height, g.m, a.m), 5) AS ceiling_height FROM flats LEFT JOIN g ON k = locality_name, a
""")
def fill_group_mean(t: Tables) -> DataFrame:
    df = quality.fill_group_mean(flats(t, "line_key", "locality_name", "ceiling_height"), "ceiling_height", ["locality_name"])
    return df.select("line_key", F.round("ceiling_height", 5).alias("ceiling_height"))


@job("dq09_chained_group_fill", WITH + """
    , a AS (SELECT line_key, locality_name AS loc, floors_total, balcony, coalesce(ceiling_height,
                round_even(avg(ceiling_height) FILTER (WHERE locality_name IS NOT NULL) OVER (PARTITION BY locality_name) * 100, 0) / 100, avg(ceiling_height) OVER ()) AS h FROM flats),
    b AS (SELECT line_key, loc, h, balcony, coalesce(floors_total, CASE WHEN loc IS NOT NULL THEN round_even(avg(floors_total) OVER (PARTITION BY loc, h) * 100, 0) / 100 END, avg(floors_total) OVER ()) AS f FROM a),
    c AS (SELECT line_key, h, f, coalesce(balcony, CASE WHEN loc IS NOT NULL THEN round_even(avg(balcony) OVER (PARTITION BY loc, h, f) * 100, 0) / 100 END, avg(balcony) OVER ()) AS b FROM b)
    SELECT line_key, round(h, 5) AS ceiling_height, round(f, 5) AS floors_total, round(b, 5) AS balcony FROM c
""")
def chained_fill(t: Tables) -> DataFrame:
    df = flats(t, "line_key", "locality_name", "ceiling_height", "floors_total", "balcony")
    keys = ["locality_name"]
    steps = []
    for col in ("ceiling_height", "floors_total", "balcony"):
        steps.append((col, list(keys)))
        keys.append(col)
    got = quality.fill_chain(df, steps)
    return got.select("line_key", *[F.round(c, 5).alias(c) for c in ("ceiling_height", "floors_total", "balcony")])


@job("dq10_fill_by_rounded_key", WITH + """
    , g AS (SELECT round_even(total_area / 10, 0) AS k, round_even(avg(living_area) * 100, 0) / 100 AS m FROM flats GROUP BY 1)
    SELECT line_key, coalesce(living_area, m, (SELECT avg(living_area) FROM flats)) AS living_area FROM flats LEFT JOIN g ON k = round_even(total_area / 10, 0)
""")
def fill_by_rounded_key(t: Tables) -> DataFrame:
    df = flats(t, "line_key", "total_area", "living_area")
    tens = {"tens": np_round(F.col("total_area") / 10)}
    return quality.fill_group_mean(df, "living_area", ["tens"], key_expr=tens).select("line_key", "living_area")


_RATIO = WITH + """, r AS (SELECT median(kitchen_area / nullif(total_area - living_area, 0)) AS m FROM flats)
    SELECT line_key, round(coalesce(kitchen_area, {value}), 5) AS kitchen_area FROM flats, r"""


@job("dq11_fill_from_ratio", _RATIO.format(value="(total_area - living_area) * m"))
def fill_from_ratio(t: Tables) -> DataFrame:
    df = quality.fill_ratio(flats(t, "line_key", "kitchen_area", "total_area", "living_area"), "kitchen_area", "total_area", "living_area")
    return df.select("line_key", F.round("kitchen_area", 5).alias("kitchen_area"))


@job("dq11_fill_from_ratio_legacy", _RATIO.format(value="total_area - living_area * m"))
def fill_from_ratio_legacy(t: Tables) -> DataFrame:
    df = quality.fill_ratio(flats(t, "line_key", "kitchen_area", "total_area", "living_area"), "kitchen_area", "total_area", "living_area", legacy=True)
    return df.select("line_key", F.round("kitchen_area", 5).alias("kitchen_area"))


@job("dq12_fill_conditional_constant", WITH + "SELECT line_key, CASE WHEN park_distance IS NULL AND parks_around = 0 THEN 3100 ELSE park_distance END AS park_distance FROM flats")
def fill_conditional(t: Tables) -> DataFrame:
    df = flats(t, "line_key", "parks_around", "park_distance")
    return quality.fill_when(df, "park_distance", F.col("parks_around") == 0, 3100.0).select("line_key", "park_distance")


@job("dq13_fill_flag", WITH + "SELECT line_key, coalesce(is_apartment, false) AS is_apartment FROM flats")
def fill_flag(t: Tables) -> DataFrame:
    return quality.fill_flag(flats(t, "line_key", "is_apartment"), "is_apartment")


_PORTS = """
    WITH c AS (SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS port FROM customer),
    g AS (SELECT port AS p, avg(c_acctbal) AS m FROM c WHERE port IS NOT NULL GROUP BY 1)
    SELECT c_custkey, coalesce(port, (SELECT p FROM g ORDER BY {rank}, p LIMIT 1)) AS port FROM c
"""


def _ports(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_acctbal", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("port"))


@job("dq14_fill_nearest_group", _PORTS.format(rank="abs(c_acctbal - m)"))
def fill_nearest(t: Tables) -> DataFrame:
    return quality.fill_nearest_group(_ports(t), "c_custkey", "port", "c_acctbal").select("c_custkey", "port")


@job("dq14_fill_nearest_group_signed", _PORTS.format(rank="c_acctbal - m"))
def fill_nearest_signed(t: Tables) -> DataFrame:
    return quality.fill_nearest_group(_ports(t), "c_custkey", "port", "c_acctbal", signed=True).select("c_custkey", "port")


@job("dq15_fill_by_several_keys", WITH + """
    , g AS (SELECT rooms AS r, balcony AS b, floors_total AS f, locality_name AS l, avg(living_area) AS m FROM flats GROUP BY ALL)
    , a AS (SELECT line_key, coalesce(living_area, round_even(m, 0)) AS living_area
            FROM flats LEFT JOIN g ON r = rooms AND b = balcony AND f = floors_total AND l = locality_name)
    SELECT line_key, coalesce(living_area, round_even((SELECT avg(living_area) FROM a), 0)) AS living_area FROM a
""")
def fill_by_several_keys(t: Tables) -> DataFrame:
    keys = ["rooms", "balcony", "floors_total", "locality_name"]
    df = quality.fill_group_mean(flats(t, "line_key", "living_area", *keys), "living_area", keys, half_even_int=True, overall_after=True)
    return df.select("line_key", "living_area")


@job("dq16_fill_unknown", WITH + "SELECT line_key, coalesce(locality_name, 'unknown') AS locality_name FROM flats")
def fill_unknown(t: Tables) -> DataFrame:
    return flats(t, "line_key", "locality_name").fillna("unknown", ["locality_name"])


@job("dq17_sequential_quantile_trims", WITH + """
    , a AS (SELECT * FROM flats WHERE last_price <= (SELECT quantile_cont(last_price, 0.99) FROM flats)),
    b AS (SELECT * FROM a WHERE floors_total <= (SELECT quantile_cont(floors_total, 0.95) FROM a))
    SELECT line_key, last_price, floors_total, living_area FROM b WHERE living_area <= (SELECT quantile_cont(living_area, 0.99) FROM b)
""")
def quantile_trims(t: Tables) -> DataFrame:
    df = stage(flats(t, "line_key", "last_price", "floors_total", "living_area"))
    for col, q in (("last_price", 0.99), ("floors_total", 0.95), ("living_area", 0.99)):
        df = quality.trim_quantile(df, col, q)
    return df


@job("dq18_iqr_trim", """
    WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
    SELECT event_id, value FROM events, q WHERE value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)
""")
def iqr_trim(t: Tables) -> DataFrame:
    return quality.trim_iqr(t.events.select("event_id", "value"), "value")


@job("dq19_outlier_report", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count(*) FILTER (WHERE v < a - 1.5 * (b - a) OR v > b + 1.5 * (b - a)) AS outliers,
           round_even(count(*) FILTER (WHERE v < a - 1.5 * (b - a) OR v > b + 1.5 * (b - a)) * 100.0::DOUBLE / count(*) * 100, 0) / 100 AS pct
    FROM (SELECT v, quantile_cont(v, 0.25) OVER () AS a, quantile_cont(v, 0.75) OVER () AS b FROM (SELECT {e} AS v FROM {s}))""" for c, e, s in (
        ("value", "ln(1 + value)", "events"), ("user_id", "ln(1 + user_id)", "events"))))
def outlier_report(t: Tables) -> DataFrame:
    return quality.outlier_report(t.events, ["value", "user_id"])


@job("dq20_three_sigma", """
    WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events)
    SELECT event_id, value FROM events, s WHERE value < m - 3 * d OR value > m + 3 * d
""")
def three_sigma(t: Tables) -> DataFrame:
    return quality.outside_sigma(t.events.select("event_id", "value"), "value", 3)


@job("dq21_domain_cut", WITH + "SELECT line_key, total_area FROM flats WHERE total_area < 80")
def domain_cut(t: Tables) -> DataFrame:
    return flats(t, "line_key", "total_area").filter("total_area < 80")


@job("dq22_repair_heights", WITH + """
    SELECT line_key, round(CASE WHEN ceiling_height > 10 THEN ceiling_height / 10 ELSE ceiling_height END, 6) AS tenth,
           round(CASE WHEN ceiling_height > 100 THEN round_even(ceiling_height / 100 * 100, 0) / 100 WHEN ceiling_height > 20 THEN round_even(ceiling_height / 10 * 100, 0) / 100
                WHEN ceiling_height > 11 THEN ceiling_height - 10 ELSE ceiling_height END, 6) AS steps FROM flats
""")
def repair_heights(t: Tables) -> DataFrame:
    c = F.col("ceiling_height")
    return flats(t, "line_key", "ceiling_height").select(
        "line_key", F.round(quality.repair_height(c), 6).alias("tenth"), F.round(quality.repair_height(c, "steps"), 6).alias("steps"))


@job("dq23_replace_and_cast", WITH + "SELECT line_key, CAST(CASE WHEN rooms = 0 THEN 1 ELSE rooms END AS INTEGER) AS rooms, CAST(coalesce(balcony, 0) AS INTEGER) AS balcony FROM flats")
def replace_and_cast(t: Tables) -> DataFrame:
    df = flats(t, "line_key", "rooms", "balcony").replace(0.0, 1.0, ["rooms"]).fillna(0, ["balcony"])
    return df.select("line_key", F.col("rooms").cast("int").alias("rooms"), F.col("balcony").cast("int").alias("balcony"))


@job("dq24_rows_before_and_after", WITH + "SELECT count(*) AS rows_before, count(*) FILTER (WHERE floors_total IS NOT NULL) AS rows_after FROM flats")
def before_after(t: Tables) -> DataFrame:
    df = flats(t, "floors_total")
    return quality.before_after(df, df.dropna())


@job("dq25_distinct_names_around_replacement", """
    SELECT count(DISTINCT p_name) AS names_before, count(DISTINCT replace(replace(p_name, 'small ', 'tiny '), 'blue ', 'navy ')) AS names_after FROM part
""")
def distinct_names(t: Tables) -> DataFrame:
    after = replace_longest(F.col("p_name"), {"small ": "tiny ", "blue ": "navy "})
    return t.part.agg(F.count_distinct("p_name").alias("names_before"), F.count_distinct(after).alias("names_after"))
