"""The longer studies: listings, passengers, signals and question sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import np_round
from tidewater.operators import aggregates, listings, models, ordering, passengers, quality, signal, stats
from tidewater.plans.flats import SQL, flats
from tidewater.registry import job
from tidewater.staging import stage
from tidewater.tables import Tables


def _case(col: str) -> str:
    edges, labels = listings.RANGES[col]
    whens = []
    for low, high, label in zip(edges, edges[1:], labels):
        upper = "" if high == float("inf") else f" AND {col} < {high}"
        whens.append(f"WHEN {col} >= {low}{upper} THEN '{label}'")
    return "CASE " + " ".join(whens) + f" END AS {col}_range"


def _round2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def _chain_sql() -> str:
    """Group fills as window averages, one common table per column."""
    parts, keys, last = [], ["locality_name"], "binned"
    for i, c in enumerate(listings.CHAIN):
        value = "steps" if c == "ceiling_height" else c
        src = f"(SELECT *, {_STEPS} AS steps FROM {last})" if c == "ceiling_height" else last
        group = f"CASE WHEN locality_name IS NOT NULL THEN {_round2(f'avg({value}) OVER (PARTITION BY ' + ', '.join(keys) + ')')} END"
        parts.append(f"c{i} AS MATERIALIZED (SELECT * REPLACE (coalesce({value}, {group}, avg({c}) OVER ()) AS {c}) FROM {src})")
        last = f"c{i}"
        keys.append(c)
    return ", ".join(parts)


_STEPS = f"""CASE WHEN ceiling_height > 100 THEN {_round2('ceiling_height / 100')} WHEN ceiling_height > 20 THEN {_round2('ceiling_height / 10')}
    WHEN ceiling_height > 11 THEN ceiling_height - 10 ELSE ceiling_height END"""
_FAIR = f"""
    WITH {SQL},
    filled AS (SELECT * REPLACE (coalesce(balcony, 0) AS balcony), {_round2('last_price / nullif(total_area, 0)')} AS price_per_m2, year(first_day) AS year FROM flats),
    s AS (SELECT max(center_distance) AS a, max(park_distance) AS b, min(floor) AS c, avg(living_area) AS d, avg(ceiling_height) AS e FROM filled),
    whole AS MATERIALIZED (SELECT filled.* REPLACE (coalesce(center_distance, a) AS center_distance, coalesce(park_distance, b) AS park_distance, coalesce(floor, c) AS floor,
              coalesce(living_area, d) AS living_area, coalesce(ceiling_height, e) AS ceiling_height) FROM filled, s),
    binned AS MATERIALIZED (SELECT *, {', '.join(_case(c) for c in listings.RANGES)} FROM whole),
    {_chain_sql()},
    fair AS (SELECT *, CASE WHEN locality_name IS NOT NULL AND {' AND '.join(f'{c}_range IS NOT NULL' for c in listings.RANGES)}
              THEN {_round2('CAST(sum(CAST(price_per_m2 AS DECIMAL(28,6))) OVER g AS DOUBLE) / count(price_per_m2) OVER g')} END AS fair_price_m2
              FROM c4 WINDOW g AS (PARTITION BY locality_name, rooms, {', '.join(f'{c}_range' for c in listings.RANGES)}))
"""


@job("q30_fair_price_by_year", _FAIR + "SELECT year, round(avg(price_per_m2), 4) AS price_per_m2, round(avg(fair_price_m2), 4) AS fair_price_m2 FROM fair GROUP BY year")
def fair_price_by_year(t: Tables) -> DataFrame:
    y = listings.yearly_prices(listings.fair_prices(flats(t)))
    return y.select(F.col("year").cast("long").alias("year"), *[F.round(c, 4).alias(c) for c in ("price_per_m2", "fair_price_m2")])


@job("q30_fair_price_per_flat", _FAIR + """
    SELECT line_key, locality_name, rooms, round(ceiling_height, 4) AS ceiling_height, round(days_on_sale, 4) AS days_on_sale, price_per_m2, fair_price_m2 FROM fair
""")
def fair_price_per_flat(t: Tables) -> DataFrame:
    return listings.fair_prices(flats(t)).select(
        "line_key", "locality_name", "rooms", F.round("ceiling_height", 4).alias("ceiling_height"), F.round("days_on_sale", 4).alias("days_on_sale"),
        "price_per_m2", "fair_price_m2")


_SKIP = (1995, 2001)


def _clean_sql(trims: dict, skip: tuple[int, ...] = _SKIP, flagged: bool = True) -> str:
    """The cleaning steps as a chain of common tables."""
    steps: list[str] = []
    last = ["flats"]

    def add(select: str, where: str = "") -> None:
        name = f"s{len(steps)}"
        steps.append(f"{name} AS MATERIALIZED (SELECT {select} FROM {last[0]} {where})")
        last[0] = name

    def trim(c: str) -> None:
        kind, x = trims.get(c, (None, None))
        p = last[0]
        if kind == "quantile":
            add("*", f"WHERE {c} <= (SELECT quantile_cont({c}, {x}) FROM {p})")
        elif kind == "iqr":
            q = f"(SELECT quantile_cont({c}, 0.25) - {x} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM {p})"
            r = f"(SELECT quantile_cont({c}, 0.75) + {x} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM {p})"
            add("*", f"WHERE {c} BETWEEN {q} AND {r}")
        elif kind == "below":
            add("*", f"WHERE {c} < {x}")

    trim("images")
    trim("last_price")
    add("* REPLACE (round_even(last_price, 0) AS last_price)")
    trim("total_area")
    add("* REPLACE (CASE WHEN rooms = 0 THEN 1 ELSE rooms END AS rooms)")
    trim("rooms")
    add("* REPLACE (CASE WHEN ceiling_height > 10 THEN ceiling_height / 10 ELSE ceiling_height END AS ceiling_height)")
    add(f"* REPLACE (coalesce(ceiling_height, {_round2('avg(ceiling_height) OVER ()')}) AS ceiling_height)")
    trim("ceiling_height")
    add("*", "WHERE floors_total IS NOT NULL")
    trim("floors_total")
    add("* REPLACE (coalesce(living_area, avg(living_area) OVER (PARTITION BY round_even(total_area, 0))) AS living_area)")
    add("* REPLACE (CASE WHEN round_even(total_area, 0) = 15 THEN 11 ELSE living_area END AS living_area)")
    trim("living_area")
    add(f"* REPLACE ({_round2('living_area')} AS living_area)")
    trim("floor")
    add("* REPLACE (coalesce(balcony, 0) AS balcony, coalesce(is_apartment, false) AS is_apartment)" if flagged else "* EXCLUDE (is_apartment) REPLACE (coalesce(balcony, 0) AS balcony)")
    trim("balcony")
    p = last[0]
    m = f"(SELECT round_even(median(kitchen_area / nullif(total_area - living_area, 0)) * 10, 0) / 10 FROM {p})"
    add(f"* REPLACE (coalesce(kitchen_area, (total_area - living_area) * {m}) AS kitchen_area)")
    trim("kitchen_area")
    add("* REPLACE (coalesce(days_on_sale, 0) AS days_on_sale)")
    trim("days_on_sale")
    add(f"""* REPLACE (replace(replace(locality_name, 'посёлок городского типа', 'поселок'), 'посёлок', 'поселок') AS locality_name,
            CASE WHEN park_distance IS NULL AND parks_around = 0 THEN 3100 ELSE park_distance END AS park_distance),
            year(first_day) AS year, month(first_day) AS month, isodow(first_day) - 1 AS weekday, {_round2('last_price / nullif(total_area, 0)')} AS price_per_m2,
            CASE WHEN floor = 1 AND floors_total = 1 THEN 'Первый и последний' WHEN floor = 1 THEN 'Первый' WHEN floor = floors_total THEN 'Последний' ELSE 'Другой' END AS floor_type""")
    if skip:
        add("*", f"WHERE year NOT IN {skip}")
    trim("price_per_m2")
    return f"""WITH {SQL}, {', '.join(steps)}
        SELECT line_key, last_price, CAST(rooms AS INTEGER) AS rooms, round(ceiling_height, 6) AS ceiling_height, CAST(floors_total AS INTEGER) AS floors_total, living_area,
               round(kitchen_area, 5) AS kitchen_area, CAST(balcony AS INTEGER) AS balcony, {"is_apartment, " if flagged else ""}CAST(days_on_sale AS INTEGER) AS days_on_sale, locality_name,
               park_distance, CAST(month AS INTEGER) AS month, CAST(weekday AS INTEGER) AS weekday, price_per_m2, floor_type FROM {last[0]}"""


def _cleaned(t: Tables, trims: dict, skip: tuple[int, ...] = _SKIP, flagged: bool = True) -> DataFrame:
    got = listings.clean(flats(t), trims, skip, flagged)
    return got.select("line_key", "last_price", F.col("rooms").cast("int").alias("rooms"), F.round("ceiling_height", 6).alias("ceiling_height"), "floors_total", "living_area",
                      F.round("kitchen_area", 5).alias("kitchen_area"), "balcony", *(["is_apartment"] if flagged else []), "days_on_sale", "locality_name", "park_distance", "month", "weekday",
                      "price_per_m2", "floor_type")


@job("q31_cleaning_by_percentiles", _clean_sql(listings.PERCENTILE, (), False))
def cleaning_percentiles(t: Tables) -> DataFrame:
    return _cleaned(t, listings.PERCENTILE, (), False)


@job("q31_cleaning_by_iqr", _clean_sql(listings.IQR))
def cleaning_iqr(t: Tables) -> DataFrame:
    return _cleaned(t, listings.IQR)


@job("q31_cleaning_mixed", _clean_sql(listings.MIXED))
def cleaning_mixed(t: Tables) -> DataFrame:
    return _cleaned(t, listings.MIXED)


_ROUNDED, _PLAIN = ("total_area", "living_area", "kitchen_area", "center_distance"), ("rooms", "floors_total", "floor", "ceiling_height")


@job("q32_price_profile", f"WITH {SQL} " + " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, round(round_even({c}, 0), 6) AS x, CAST(sum(CAST(last_price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price, count(*) AS cnt FROM flats WHERE {c} IS NOT NULL GROUP BY ALL" for c in _ROUNDED]
    + [f"SELECT '{c}', round({c}, 6), CAST(sum(CAST(last_price AS DECIMAL(18,2))) AS DOUBLE) / count(*), count(*) FROM flats WHERE {c} IS NOT NULL GROUP BY ALL" for c in _PLAIN]))
def price_profile(t: Tables) -> DataFrame:
    # Heights are rounded first: they are sums of floats, and the profile needs equal keys.
    df = flats(t, "last_price", *_ROUNDED, *_PLAIN).withColumn("ceiling_height", F.round("ceiling_height", 6))
    got = listings.price_profile(df, _ROUNDED, _PLAIN, "last_price")
    return got.select("feature", F.round("x", 6).alias("x"), "mean_price", "cnt")


@job("q32_price_of_top_places", f"""
    WITH {SQL}, k AS (SELECT locality_name AS l FROM flats WHERE locality_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)
    SELECT locality_name, round(avg(last_price / total_area), 4) AS price_per_m2, count(*) AS cnt FROM flats JOIN k ON l = locality_name GROUP BY 1
""")
def price_of_top_places(t: Tables) -> DataFrame:
    top = ordering.restrict_to_top(flats(t, "locality_name", "last_price", "total_area"), "locality_name", 10)
    per_m2 = F.try_divide(F.col("last_price"), F.col("total_area"))
    return top.groupBy("locality_name").agg(F.round(F.avg(per_m2), 4).alias("price_per_m2"), F.count(F.lit(1)).alias("cnt"))


@job("q32_price_by_km_to_center", f"""
    WITH {SQL} SELECT round_even(center_distance / 1000, 0) AS km, round(avg(last_price / total_area), 4) AS price_per_m2 FROM flats WHERE locality_name = 'Brand#7' AND center_distance IS NOT NULL GROUP BY 1
""")
def price_by_km(t: Tables) -> DataFrame:
    near = flats(t, "locality_name", "center_distance", "last_price", "total_area").filter("locality_name = 'Brand#7' AND center_distance IS NOT NULL")
    per_m2 = F.try_divide(F.col("last_price"), F.col("total_area"))
    return near.groupBy(np_round(F.col("center_distance") / 1000).alias("km")).agg(F.round(F.avg(per_m2), 4).alias("price_per_m2"))


_PASSENGER_COLUMNS = {
    "PassengerId": "c_custkey",
    "Survived": "CASE WHEN (c_custkey * 7 + c_nationkey) % 5 < 2 THEN 1 ELSE 0 END",
    "Pclass": "c_nationkey % 3 + 1",
    "Name": "concat(c_name, CASE c_custkey % 4 WHEN 0 THEN ', Mr. A' WHEN 1 THEN ', Mrs. B' WHEN 2 THEN ', Miss. C' ELSE ' D' END)",
    "Sex": "CASE WHEN c_custkey % 4 IN (1, 2) THEN 'female' ELSE 'male' END",
    "Age": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST((c_custkey * 31 + c_nationkey) % 80 AS DOUBLE) END",
    "SibSp": "c_custkey % 3",
    "Parch": "c_nationkey % 2",
    "Fare": "CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE abs(c_acctbal) / 16 END",
    "Cabin": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END",
    "Embarked": "CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_acctbal > 6000 THEN 'C' WHEN c_acctbal > 2000 THEN 'Q' ELSE 'S' END",
}


def _passengers(t: Tables) -> DataFrame:
    return t.customer.selectExpr(*[f"{rule} AS {name}" for name, rule in _PASSENGER_COLUMNS.items()])


_TITANIC = f"""
    WITH p AS (SELECT {', '.join(f'{rule} AS {name}' for name, rule in _PASSENGER_COLUMNS.items())} FROM customer),
    f AS MATERIALIZED (SELECT * REPLACE (coalesce(Fare, avg(Fare) OVER ()) AS Fare) FROM p),
    m AS MATERIALIZED (SELECT Embarked AS port, avg(Fare) AS c FROM f WHERE Embarked IS NOT NULL GROUP BY 1),
    e AS MATERIALIZED (SELECT * REPLACE (coalesce(Embarked, (SELECT port FROM m ORDER BY abs(Fare - c), port LIMIT 1)) AS Embarked) FROM f),
    g AS MATERIALIZED (SELECT * REPLACE (coalesce(Age, round_even(avg(Age) OVER (PARTITION BY Pclass, Survived, SibSp, Parch, Embarked), 0)) AS Age) FROM e),
    a AS MATERIALIZED (SELECT * REPLACE (coalesce(Age, round_even(avg(Age) OVER (), 0)) AS Age, coalesce(Cabin, 'unknown') AS Cabin) FROM g),
    x AS MATERIALIZED (SELECT PassengerId, Survived, Age, Fare, Cabin, CASE Sex WHEN 'male' THEN 0 WHEN 'female' THEN 1 ELSE -1 END AS Sex, CASE Embarked WHEN 'C' THEN 0 WHEN 'Q' THEN 1 WHEN 'S' THEN 2 ELSE -1 END AS Embarked,
               CASE regexp_extract(Name, ' ([A-Za-z]+)\\.', 1) WHEN 'Mr' THEN 0 WHEN 'Mrs' THEN 1 WHEN 'Miss' THEN 2 ELSE -1 END AS title, Pclass, SibSp, Parch FROM a)
"""
_TITANIC_NEAR = _TITANIC + """,
    d AS (SELECT q.PassengerId, q.Survived AS truth, t.PassengerId AS nb, t.Survived AS y, sqrt(pow(q.Pclass - t.Pclass, 2) + pow(q.Sex - t.Sex, 2) + pow(q.Age - t.Age, 2)
          + pow(q.SibSp - t.SibSp, 2) + pow(q.Parch - t.Parch, 2) + pow(q.Fare - t.Fare, 2) + pow(q.Embarked - t.Embarked, 2) + pow(q.title - t.title, 2)) AS dist
          FROM x q, x t WHERE q.PassengerId % 5 = 0 AND t.PassengerId % 5 <> 0),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY PassengerId ORDER BY dist, nb) AS rn FROM d) WHERE rn <= 15),
    v AS (SELECT PassengerId, truth, y, count(*) AS n FROM k GROUP BY ALL),
    r AS (SELECT PassengerId, any_value(truth) AS truth, arg_min(y, (-n, y)) AS predicted FROM v GROUP BY PassengerId)
"""


@job("q33_passenger_preparation", _TITANIC + """
    SELECT PassengerId, Survived, round(Age, 6) AS Age, round(Fare, 7) AS Fare, Cabin, Sex, Embarked, title FROM x
""")
def passenger_preparation(t: Tables) -> DataFrame:
    got = passengers.prepare(_passengers(t))
    return got.select("PassengerId", "Survived", F.round("Age", 6).alias("Age"), F.round("Fare", 7).alias("Fare"), "Cabin", "Sex", "Embarked", "title")


def _passenger_calls(t: Tables) -> DataFrame:
    ready = passengers.prepare(_passengers(t))
    train, valid = ready.filter("PassengerId % 5 <> 0"), ready.filter("PassengerId % 5 = 0")
    called = models.knn(train, valid, "features", "Survived", "PassengerId", 15)
    return valid.select("PassengerId", F.col("Survived").alias("truth"), "Sex").join(called, "PassengerId")


@job("q33_passenger_predictions", _TITANIC_NEAR + "SELECT PassengerId, truth, predicted FROM r")
def passenger_predictions(t: Tables) -> DataFrame:
    return _passenger_calls(t).select("PassengerId", "truth", "predicted")


@job("q33_passenger_score", _TITANIC_NEAR + """
    SELECT round(avg(CASE WHEN truth = predicted THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy, count(*) FILTER (WHERE predicted <> Sex) AS differs_from_sex_rule FROM r JOIN x USING (PassengerId)
""")
def passenger_score(t: Tables) -> DataFrame:
    called = _passenger_calls(t)
    return called.agg(F.round(F.avg((F.col("truth") == F.col("predicted")).cast("double")), 8).alias("accuracy"),
                      F.count_if(F.col("predicted") != F.col("Sex")).alias("differs_from_sex_rule"))


@job("q34_signal_restored_full", "SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, round(value, 4) AS v FROM events")
def signal_restored_full(t: Tables) -> DataFrame:
    """With as many components as samples per chunk the signal comes back whole."""
    chunks = stage(signal.chunk(t.events, ["ts", "event_id"], "value", 16))
    fit = signal.pca_fit(chunks, "samples", 16)
    back = signal.pca_inverse(signal.pca_transform(chunks, "samples", fit), "scores", fit)
    return signal.unchunk(back, 16, t.events.count(), "restored").select("pos", F.round("v", 4).alias("v"))


@job("q34_signal_compression")
def signal_compression(t: Tables) -> DataFrame:
    chunks = stage(signal.chunk(t.events, ["ts", "event_id"], "value", 50))
    fit = signal.pca_fit(chunks, "samples", 40)
    return signal.pca_curve(chunks, "samples", fit, [5, 10, 20, 40])


@job("q35_weather_questions", """
    SELECT (SELECT round(median(value), 4) FROM events WHERE event_type = 'click') AS click_median, (SELECT round(stddev_samp(value), 4) FROM events WHERE event_type = 'click') AS click_std,
           (SELECT round(max(value) - min(value), 4) FROM events WHERE event_type = 'click') AS click_range, (SELECT round(avg(value), 4) FROM events WHERE value < 20) AS cold_mean,
           (SELECT round(median(value), 4) FROM events WHERE event_type = 'click' AND user_id > (SELECT avg(user_id) FROM events)) AS windy_median,
           (SELECT k FROM (SELECT json_extract_string(props, '$.k') AS k FROM events) GROUP BY k ORDER BY count(*), k LIMIT 1) AS rarest_k
""")
def weather_questions(t: Tables) -> DataFrame:
    clicks = t.events.filter("event_type = 'click'")
    windy = clicks.filter(F.col("user_id") > t.events.agg(F.avg("user_id")).scalar())
    cold = F.when(F.col("value") < 20, 0).when(F.col("value") <= 60, 1).when(F.col("value") > 60, 2).otherwise(0)
    rarest = stats.extreme_value(t.events.select(F.get_json_object("props", "$.k").alias("k")), "k", most=False).select("value")
    one = clicks.agg(F.round(F.stddev_samp("value"), 4).alias("click_std"), F.round(F.max("value") - F.min("value"), 4).alias("click_range"))
    return one.select(
        F.round(stats.exact_quantiles(clicks, "value", {"q": 0.5}).scalar(), 4).alias("click_median"), "click_std", "click_range",
        F.round(t.events.filter(cold == 0).agg(F.avg("value")).scalar(), 4).alias("cold_mean"),
        F.round(stats.exact_quantiles(windy, "value", {"q": 0.5}).scalar(), 4).alias("windy_median"), rarest.scalar().alias("rarest_k"))


@job("q35_character_questions", """
    WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events WHERE event_type = 'view'),
    m AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events)
    SELECT (SELECT count(*) FROM events, m WHERE value NOT BETWEEN m - 3 * d AND m + 3 * d) AS outside_three_sigma,
           (SELECT user_id FROM events WHERE event_type = 'view' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_before,
           (SELECT user_id FROM events, q WHERE event_type = 'view' AND value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_after
""")
def character_questions(t: Tables) -> DataFrame:
    views = t.events.filter("event_type = 'view'")
    inside = quality.trim_iqr(views, "value")
    outside = quality.outside_sigma(t.events, "value", 3).agg(F.count(F.lit(1)).alias("outside_three_sigma"))
    return outside.select("outside_three_sigma", stats.mode_value(views, "user_id").scalar().alias("mode_before"),
                          stats.mode_value(inside, "user_id").scalar().alias("mode_after"))


@job("q35_court_questions", """
    WITH a AS (SELECT l_suppkey, count(*) * sum(l_linenumber) AS times FROM lineitem GROUP BY 1),
    m AS (SELECT l_suppkey FROM a WHERE times = (SELECT max(times) FROM a)),
    l AS (SELECT * FROM lineitem WHERE l_suppkey IN (FROM m)),
    j AS (SELECT l_returnflag AS judge FROM l UNION ALL SELECT l_linestatus FROM l UNION ALL SELECT left(l_returnflag, 1) FROM l)
    SELECT judge AS value, count(*) AS cnt FROM j GROUP BY 1 ORDER BY cnt DESC, judge DESC LIMIT 1
""")
def court_questions(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_suppkey").agg((F.count(F.lit(1)) * F.sum("l_linenumber")).alias("times"))
    top = aggregates.rows_at_extreme(per, "times").select("l_suppkey")
    rows = t.lineitem.join(top, "l_suppkey", "left_semi")
    judges = rows.select(F.explode(F.array("l_returnflag", "l_linestatus", F.left("l_returnflag", F.lit(1)))).alias("judge"))
    return stats.extreme_value(judges, "judge")


@job("q36_catalog_questions", """
    SELECT (SELECT count(*) FROM part WHERE p_type = 'SMALL') AS small_cnt, (SELECT count(*) FROM part WHERE p_type <> 'SMALL') AS other_cnt,
           (SELECT max(p_retailprice) FROM part WHERE p_type = 'SMALL') AS small_max, (SELECT p_name FROM part ORDER BY p_partkey DESC LIMIT 1 OFFSET 2) AS third_from_end,
           (SELECT count(*) FROM part WHERE p_size = (SELECT min(p_size) FROM part)) AS at_min_size
""")
def catalog_questions(t: Tables) -> DataFrame:
    small = F.col("p_type") == "SMALL"
    one = t.part.agg(F.count_if(small).alias("small_cnt"), F.count_if(~small).alias("other_cnt"), F.max(F.when(small, F.col("p_retailprice"))).alias("small_max"))
    third = ordering.nth_row(t.part, ["p_partkey"], 3, from_end=True).select("p_name").scalar()
    least = aggregates.rows_at_extreme(t.part, "p_size", largest=False).agg(F.count(F.lit(1))).scalar()
    return one.select("*", third.alias("third_from_end"), least.alias("at_min_size"))


@job("q36_last_rows_filled", """
    SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END, '') AS p_name, coalesce(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END, 0) AS p_size
    FROM part ORDER BY p_partkey DESC LIMIT 10
""")
def last_rows_filled(t: Tables) -> DataFrame:
    holes = t.part.select("p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("p_name"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_size")).alias("p_size"))
    return quality.fill_by_type(ordering.last_n(holes, ["p_partkey"], 10))
