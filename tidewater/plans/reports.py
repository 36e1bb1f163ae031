"""The named SQL-style reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import dates, numbers
from tidewater.functions.numbers import exact_sum, money
from tidewater.operators import windows
from tidewater.operators.ordering import top_k_with_ties
from tidewater.operators.ranges import bucket_spine, interval_counts, left_bucket_join
from tidewater.operators.sets import union_tagged
from tidewater.registry import job
from tidewater.tables import Tables


@job("q01_groups_by_range_and_ratio", """
    SELECT DISTINCT p_brand, p_type FROM part
    WHERE p_size BETWEEN 10 AND 30 AND p_retailprice > 950
      AND CASE WHEN p_size = 0 THEN 0 ELSE p_retailprice / p_size END > 60
""")
def groups_by_range_and_ratio(t: Tables) -> DataFrame:
    ratio = numbers.safe_ratio(F.col("p_retailprice"), F.col("p_size"))
    kept = t.part.filter(F.col("p_size").between(10, 30) & (F.col("p_retailprice") > 950) & (ratio > 60))
    return kept.select("p_brand", "p_type").distinct()


@job("q02_name_differs_from_local_name", """
    SELECT p_partkey, p_name, p_type FROM part
    WHERE lower(p_type) <> split_part(p_name, ' ', 1)
""")
def name_differs(t: Tables) -> DataFrame:
    first = F.get(F.split("p_name", " "), F.lit(0))
    return t.part.filter(F.lower("p_type") != first).select("p_partkey", "p_name", "p_type").orderBy("p_name", "p_partkey")


@job("q03_biggest_member_per_group", """
    SELECT p_brand, arg_min(p_name, (-p_retailprice, p_name, p_partkey)) AS priciest_part,
           max(p_retailprice) AS price
    FROM part GROUP BY p_brand
""")
def biggest_member(t: Tables) -> DataFrame:
    order = F.struct((-F.col("p_retailprice")).alias("price"), "p_name", "p_partkey")
    return t.part.groupBy("p_brand").agg(
        F.min_by("p_name", order).alias("priciest_part"), F.max("p_retailprice").alias("price"))


@job("q04_distinct_with_list_and_bound", """
    SELECT DISTINCT c_mktsegment FROM customer WHERE c_acctbal < 61 AND c_nationkey IN (1, 3, 5, 7)
""")
def distinct_with_list(t: Tables) -> DataFrame:
    kept = t.customer.filter((F.col("c_acctbal") < 61) & F.col("c_nationkey").isin(1, 3, 5, 7))
    return kept.select("c_mktsegment").distinct().orderBy("c_mktsegment")


@job("q05_name_contains_code", """
    SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%' || p_type || '%'
""")
def name_contains_code(t: Tables) -> DataFrame:
    hit = F.expr("p_name ILIKE concat('%', p_type, '%')")
    return t.part.filter(hit).select("p_partkey", "p_name").orderBy("p_name", "p_partkey")


@job("q06_durations_in_minutes", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST((epoch(l_shipdate) - epoch(o_orderdate)) / 60 AS DOUBLE) AS duration_min
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE o_orderpriority = '1-URGENT'
      AND o_orderdate >= TIMESTAMP '1997-02-20' AND o_orderdate < TIMESTAMP '1997-04-20'
""")
def durations(t: Tables) -> DataFrame:
    orders = t.orders.filter(
        (F.col("o_orderpriority") == "1-URGENT") & dates.in_days(F.col("o_orderdate"), "1997-02-20", "1997-04-19"))
    both = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       dates.minutes_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("duration_min"))


@job("q07_share_of_population", """
    WITH pop AS (SELECT c_nationkey, count(*) AS population FROM customer GROUP BY c_nationkey),
    part_of AS (SELECT c_nationkey, c_mktsegment, count(*) * 100.0::DOUBLE / any_value(population) AS pct, any_value(population) AS population
                FROM customer JOIN pop USING (c_nationkey) GROUP BY c_nationkey, c_mktsegment)
    SELECT c_nationkey, n_name, c_mktsegment, c_mktsegment = 'BUILDING' AS is_main,
           round(population * pct / 100, 6) AS people
    FROM part_of JOIN nation ON n_nationkey = c_nationkey WHERE pct >= 18
""")
def share_of_population(t: Tables) -> DataFrame:
    c = t.customer
    population = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("population"))
    pct = F.col("cnt") * F.lit(100.0) / F.col("population")
    shares = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("cnt")).join(population, "c_nationkey")
    named = shares.withColumn("pct", pct).filter("pct >= 18").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    main = F.col("c_mktsegment") == "BUILDING"
    people = F.round(F.col("population") * F.col("pct") / 100, 6)
    return named.select("c_nationkey", "n_name", "c_mktsegment", main.alias("is_main"), people.alias("people")).orderBy(
        "n_name", F.when(F.col("is_main"), 1).otherwise(2), F.col("people").desc())


@job("q08_top_ten_by_dense_rank", """
    SELECT c_custkey, c_name, c_acctbal, rank1 FROM (
        SELECT *, dense_rank() OVER (ORDER BY c_acctbal DESC) AS rank1 FROM customer WHERE c_mktsegment = 'BUILDING')
    WHERE rank1 <= 10
""")
def top_ten_balances(t: Tables) -> DataFrame:
    building = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return top_k_with_ties(building, "c_acctbal", 10, rank_col="rank1").select(
        "c_custkey", "c_name", "c_acctbal", "rank1").orderBy("rank1", "c_custkey")


@job("q09_gazetteer", """
    SELECT left(geo_name, 1) AS first_letter, geo_name, geo_type FROM (
        SELECT DISTINCT 'region' AS geo_type, r_name AS geo_name FROM region
        UNION ALL SELECT 'nation', n_name FROM nation
        UNION ALL SELECT DISTINCT 'segment', c_mktsegment FROM customer)
""")
def gazetteer(t: Tables) -> DataFrame:
    named = union_tagged({
        "region": t.region.select(F.col("r_name").alias("geo_name")).distinct(),
        "nation": t.nation.select(F.col("n_name").alias("geo_name")),
        "segment": t.customer.select(F.col("c_mktsegment").alias("geo_name")).distinct(),
    }, tag="geo_type")
    return named.select(F.left("geo_name", F.lit(1)).alias("first_letter"), "geo_name", "geo_type").orderBy("geo_name", "geo_type")


@job("q10_percent_of_first_line", """
    WITH first AS (SELECT l_orderkey, arg_min(l_extendedprice, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS first_price,
                          arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS first_part
                   FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, l_partkey, l_linenumber, first_part,
           CASE WHEN first_price = 0 THEN 0 ELSE round(l_extendedprice / first_price * 100, 4) END AS pct_of_first
    FROM lineitem JOIN first USING (l_orderkey)
""")
def percent_of_first_line(t: Tables) -> DataFrame:
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = windows.with_group_value(t.lineitem, ["l_orderkey"], bounded=True, _first=F.min(order))
    first = F.col("_first.l_extendedprice")
    pct = F.when(first == 0, 0.0).otherwise(F.round(F.try_divide(F.col("l_extendedprice"), first) * 100, 4))
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", F.col("_first.l_partkey").alias("first_part"),
                        pct.alias("pct_of_first"))


@job("q11_night_and_morning_champions", """
    WITH placed AS (
        SELECT event_type AS direction,
               (ts AT TIME ZONE 'UTC') AT TIME ZONE coalesce(
                   CASE user_id % 3 WHEN 0 THEN 'Europe/Moscow' WHEN 1 THEN 'America/New_York' END, 'UTC') AS local_ts
        FROM events),
    counted AS (
        SELECT direction,
               CAST(sum(CASE WHEN strftime(local_ts, '%H:%M:%S') >= '21:00:00' OR strftime(local_ts, '%H:%M:%S') <= '01:00:00' THEN 1 ELSE 0 END) AS BIGINT) AS night_cnt,
               CAST(sum(CASE WHEN strftime(local_ts, '%H:%M:%S') BETWEEN '06:00:00' AND '09:00:00' THEN 1 ELSE 0 END) AS BIGINT) AS morning_cnt
        FROM placed WHERE local_ts >= TIMESTAMP '2024-01-05' AND local_ts < TIMESTAMP '2024-01-20'
        GROUP BY direction),
    ranked AS (SELECT *, dense_rank() OVER (ORDER BY night_cnt DESC) AS night_rn,
                         dense_rank() OVER (ORDER BY morning_cnt DESC) AS morning_rn FROM counted)
    SELECT CAST(sum(night_cnt) AS BIGINT) AS night_total,
           string_agg(direction, ' :: ' ORDER BY direction) FILTER (WHERE night_rn = 1) AS night_champions,
           CAST(sum(morning_cnt) AS BIGINT) AS morning_total,
           string_agg(direction, ' :: ' ORDER BY direction) FILTER (WHERE morning_rn = 1) AS morning_champions
    FROM ranked
""")
def champions(t: Tables) -> DataFrame:
    zone = F.when(F.col("user_id") % 3 == 0, "Europe/Moscow").when(F.col("user_id") % 3 == 1, "America/New_York")
    local = t.events.select(F.col("event_type").alias("direction"), dates.local_time(F.col("ts"), zone).alias("local_ts"))
    kept = local.filter((F.col("local_ts") >= "2024-01-05") & (F.col("local_ts") < "2024-01-20"))
    counted = kept.groupBy("direction").agg(
        F.count_if(dates.in_clock_band(F.col("local_ts"), "21:00:00", "01:00:00")).alias("night_cnt"),
        F.count_if(dates.in_clock_band(F.col("local_ts"), "06:00:00", "09:00:00")).alias("morning_cnt"))
    top = counted.agg(F.struct(F.max("night_cnt").alias("night"), F.max("morning_cnt").alias("morning"))).scalar()
    return counted.withColumn("top", top).agg(
        F.sum("night_cnt").alias("night_total"),
        F.expr("listagg(direction, ' :: ') WITHIN GROUP (ORDER BY direction) FILTER (WHERE night_cnt = top.night)").alias("night_champions"),
        F.sum("morning_cnt").alias("morning_total"),
        F.expr("listagg(direction, ' :: ') WITHIN GROUP (ORDER BY direction) FILTER (WHERE morning_cnt = top.morning)").alias("morning_champions"))


@job("q12_revenue_per_local_day_and_class", """
    SELECT CAST((l_shipdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS ship_day, l_returnflag,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amt
    FROM lineitem
    WHERE (l_shipdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' >= TIMESTAMP '1997-03-01'
      AND (l_shipdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' < TIMESTAMP '1998-03-01'
    GROUP BY ALL
""")
def revenue_per_local_day(t: Tables) -> DataFrame:
    zone = "America/New_York"
    # The bounds are moved to UTC, not the column, so that the filter reaches the scan.
    low = F.to_utc_timestamp(F.lit("1997-03-01").cast("timestamp"), zone).cast("timestamp_ntz")
    high = F.to_utc_timestamp(F.lit("1998-03-01").cast("timestamp"), zone).cast("timestamp_ntz")
    kept = t.lineitem.filter((F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high))
    day = F.to_date(F.from_utc_timestamp("l_shipdate", zone))
    return kept.groupBy(day.alias("ship_day"), "l_returnflag").agg(exact_sum("l_extendedprice").alias("amt")).orderBy(
        "ship_day", "l_returnflag")


@job("q13_top_categories_by_orders", """
    SELECT p_type, order_cnt, rank1 FROM (
        SELECT p_type, count(DISTINCT l_orderkey) AS order_cnt, dense_rank() OVER (ORDER BY count(DISTINCT l_orderkey) DESC) AS rank1
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type)
    WHERE rank1 <= 5
""")
def top_categories(t: Tables) -> DataFrame:
    sold = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    per_type = sold.groupBy("p_type").agg(F.count_distinct("l_orderkey").alias("order_cnt"))
    return top_k_with_ties(per_type, "order_cnt", 5, rank_col="rank1").orderBy("rank1", "p_type")


@job("q14_count_by_first_letter", """
    SELECT left(p_name, 1) AS first_letter, count(*) AS cnt FROM part GROUP BY 1
""")
def count_by_first_letter(t: Tables) -> DataFrame:
    return t.part.groupBy(F.left("p_name", F.lit(1)).alias("first_letter")).agg(F.count(F.lit(1)).alias("cnt")).orderBy("first_letter")


@job("q15_distinct_over_conditioned_join", """
    SELECT count(DISTINCT c_name) AS customer_cnt
    FROM customer JOIN orders ON o_custkey = c_custkey AND (o_orderstatus = 'F') IS TRUE AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def distinct_over_join(t: Tables) -> DataFrame:
    orders = t.orders.filter((F.col("o_orderstatus") == "F").eqNullSafe(True) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    # Only the existence of an order matters, so a semi-join does not multiply customers.
    return t.customer.join(orders, F.col("o_custkey") == F.col("c_custkey"), "left_semi").agg(
        F.count_distinct("c_name").alias("customer_cnt"))


@job("q16_above_group_average", """
    SELECT c_custkey, c_nationkey, c_acctbal FROM (
        SELECT *, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS m
        FROM customer WINDOW w AS (PARTITION BY c_nationkey))
    WHERE c_acctbal > m
""")
def above_group_average(t: Tables) -> DataFrame:
    beside = windows.with_group_value(t.customer, ["c_nationkey"], m=numbers.exact_mean("c_acctbal"))
    return beside.filter(F.col("c_acctbal") > F.col("m")).select("c_custkey", "c_nationkey", "c_acctbal")


@job("q17_present_in_both_groups", """
    SELECT l_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    GROUP BY l_partkey HAVING max(CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END) = 1 AND max(CASE WHEN n_regionkey = 1 THEN 1 ELSE 0 END) = 1
""")
def present_in_both(t: Tables) -> DataFrame:
    suppliers = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).filter(
        F.col("n_regionkey").isin(0, 1)).select("s_suppkey", "n_regionkey")
    sold = t.lineitem.join(suppliers, F.col("s_suppkey") == F.col("l_suppkey"))
    flags = sold.groupBy("l_partkey").agg(
        F.bool_or(F.col("n_regionkey") == 0).alias("a"), F.bool_or(F.col("n_regionkey") == 1).alias("b"))
    return flags.filter("a AND b").select("l_partkey")


@job("q18_two_years_by_month_and_category", """
    WITH y AS (
        SELECT month(o_orderdate) AS mm, strftime(o_orderdate, '%B') AS month_name, p_type,
               sum(CASE WHEN year(o_orderdate) = 1996 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS a,
               sum(CASE WHEN year(o_orderdate) = 1997 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS b
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
        GROUP BY ALL)
    SELECT month_name, p_type, CAST(a AS DOUBLE) AS total_1996, CAST(b AS DOUBLE) AS total_1997,
           round(CASE WHEN a = 0 THEN 1 ELSE (CAST(b AS DOUBLE) - CAST(a AS DOUBLE)) / CAST(a AS DOUBLE) * 100 END, 4) AS diff_pct
    FROM y
""")
def two_years(t: Tables) -> DataFrame:
    orders = t.orders.filter(dates.in_days(F.col("o_orderdate"), "1996-01-01", "1997-12-31"))
    lines = t.lineitem.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    def total(year: int):
        hit = F.when(F.year("o_orderdate") == year, money("l_extendedprice")).otherwise(F.lit(0).cast("decimal(18,2)"))
        return F.sum(hit).cast("double")
    y = lines.groupBy(F.month("o_orderdate").alias("mm"), F.date_format("o_orderdate", "MMMM").alias("month_name"), "p_type").agg(
        total(1996).alias("total_1996"), total(1997).alias("total_1997"))
    a, b = F.col("total_1996"), F.col("total_1997")
    diff = F.round(F.when(a == 0, 1.0).otherwise(F.try_divide(b - a, a) * 100), 4)
    return y.orderBy("mm", "p_type").select("month_name", "p_type", "total_1996", "total_1997", diff.alias("diff_pct"))


@job("q19_busiest_places", """
    WITH moves AS (
        SELECT c_nationkey AS place, 'departure' AS typ, o_orderkey AS k FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-06-01'
        UNION ALL
        SELECT s_nationkey, 'arrival', l_orderkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-06-01'),
    tickets AS (SELECT l_orderkey AS k, count(*) AS ticket_cnt FROM lineitem WHERE l_orderkey IN (SELECT k FROM moves) GROUP BY l_orderkey),
    r AS (
        SELECT coalesce(n_name, CAST(place AS VARCHAR)) AS place_name,
               CAST(sum(CASE WHEN typ = 'departure' THEN 1 ELSE 0 END) AS BIGINT) AS departure_cnt,
               CAST(sum(CASE WHEN typ = 'arrival' THEN 1 ELSE 0 END) AS BIGINT) AS arrival_cnt, count(*) AS move_cnt,
               CAST(sum(coalesce(ticket_cnt, 0)) AS BIGINT) AS ticket_cnt, dense_rank() OVER (ORDER BY count(*) DESC) AS rank1
        FROM moves LEFT JOIN nation ON n_nationkey = place LEFT JOIN tickets USING (k) GROUP BY 1)
    SELECT place_name, departure_cnt, arrival_cnt, move_cnt, ticket_cnt FROM r WHERE rank1 <= 10
""")
def busiest_places(t: Tables) -> DataFrame:
    first, last = "1997-03-01", "1997-05-31"
    out = t.orders.filter(dates.in_days(F.col("o_orderdate"), first, last)).join(
        t.customer, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_nationkey").alias("place"), F.col("o_orderkey").alias("k"))
    back = t.lineitem.filter(dates.in_days(F.col("l_shipdate"), first, last)).join(
        t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(F.col("s_nationkey").alias("place"), F.col("l_orderkey").alias("k"))
    # Moves of one order at one place are merged before the join with the ticket counts.
    moves = union_tagged({"departure": out, "arrival": back}, tag="typ").groupBy("place", "k").agg(
        F.count_if(F.col("typ") == "departure").alias("dep"), F.count_if(F.col("typ") == "arrival").alias("arr"))
    # Only orders that moved have their tickets counted.
    moved = t.lineitem.join(moves.select(F.col("k").alias("_k")).distinct(), F.col("l_orderkey") == F.col("_k"), "left_semi")
    tickets = moved.groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("tickets"))
    named = moves.join(tickets, "k", "left").join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("place"), "left")
    both = F.col("dep") + F.col("arr")
    per_place = named.groupBy(F.coalesce("n_name", F.col("place").cast("string")).alias("place_name")).agg(
        F.sum("dep").alias("departure_cnt"), F.sum("arr").alias("arrival_cnt"), F.sum(both).alias("move_cnt"),
        F.sum(both * F.coalesce("tickets", F.lit(0))).alias("ticket_cnt"))
    return top_k_with_ties(per_place, "move_cnt", 10)


@job("q20_orders_in_a_continuous_quarter", """
    WITH o AS (SELECT * FROM orders WHERE month(o_orderdate) <> 6),
    mn AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS mn FROM o),
    g AS (SELECT mn, mn - INTERVAL 1 MONTH * row_number() OVER (ORDER BY mn) AS gid FROM mn),
    p AS (SELECT min(mn) AS from_dt FROM g GROUP BY gid HAVING date_diff('day', min(mn), max(mn)) > 92 ORDER BY from_dt LIMIT 1),
    s AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mn, p_type, count(DISTINCT o_orderkey) AS order_cnt
          FROM o JOIN p ON o_orderdate >= from_dt AND o_orderdate < from_dt + INTERVAL 3 MONTH
          JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL)
    SELECT CAST(year(mn) AS INTEGER) AS order_year, CAST(month(mn) AS INTEGER) AS order_month, p_type, order_cnt,
           order_cnt - lag(order_cnt, 1, order_cnt) OVER (PARTITION BY p_type ORDER BY mn) AS diff_from_prev
    FROM s
""")
def continuous_quarter(t: Tables) -> DataFrame:
    orders = t.orders.filter(F.month("o_orderdate") != 6)
    calendar = orders.select(F.trunc("o_orderdate", "month").alias("mn")).distinct()
    runs = windows.islands(calendar, "mn").groupBy("island_id").agg(F.min("mn").alias("lo"), F.max("mn").alias("hi"))
    start = runs.filter(F.datediff("hi", "lo") > 92).agg(F.min("lo")).scalar()
    # The stored time is compared, not its day, so that the scan can skip by it.
    stored = t.orders.schema["o_orderdate"].dataType
    period = orders.filter((F.col("o_orderdate") >= start.cast(stored)) & (F.col("o_orderdate") < F.add_months(start, 3).cast(stored)))
    sold = t.lineitem.join(period, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    s = sold.groupBy(F.trunc("o_orderdate", "month").alias("mn"), "p_type").agg(F.count_distinct("o_orderkey").alias("order_cnt"))
    # Three rows per category reach this window.
    before = F.coalesce(F.lag("order_cnt").over(Window.partitionBy("p_type").orderBy("mn")), F.col("order_cnt"))
    return s.select(F.year("mn").alias("order_year"), F.month("mn").alias("order_month"), "p_type", "order_cnt",
                    (F.col("order_cnt") - before).alias("diff_from_prev")).orderBy("order_year", "order_month", "p_type")


def _part_amounts(t: Tables, first: str, last: str) -> DataFrame:
    orders = t.orders.filter(dates.in_days(F.col("o_orderdate"), first, last)).select("o_orderkey")
    return t.lineitem.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("l_partkey").agg(
        F.sum(money("l_extendedprice")).alias("amt"))


@job("q21_top_products_share_of_total", """
    WITH a AS (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amt FROM lineitem JOIN orders ON o_orderkey = l_orderkey
               WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY l_partkey),
    r AS (SELECT *, sum(amt) OVER () AS total, dense_rank() OVER (ORDER BY amt DESC) AS rn FROM a)
    SELECT l_partkey, p_name, CAST(amt AS DOUBLE) AS amt,
           round(coalesce(CAST(amt AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0), 0) * 100, 4) AS pct_of_total
    FROM r JOIN part ON p_partkey = l_partkey WHERE rn <= 10
""")
def top_products(t: Tables) -> DataFrame:
    amounts = _part_amounts(t, "1997-01-01", "1997-12-31")
    total = amounts.agg(F.sum("amt")).scalar()
    best = top_k_with_ties(amounts, "amt", 10)
    return best.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "l_partkey", "p_name", F.col("amt").cast("double").alias("amt"),
        F.round(numbers.safe_ratio(F.col("amt"), total) * 100, 4).alias("pct_of_total"))


def _order_lines(t: Tables) -> DataFrame:
    """Lines of one month's orders with the buyer's nation and its total, summed at line grain."""
    orders = t.orders.filter(dates.in_days(F.col("o_orderdate"), "1997-05-01", "1997-05-31"))
    lines = (
        orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(F.col("o_orderkey").alias("order_num"), "p_name", "p_partkey", F.col("c_nationkey").alias("city"),
                money("o_totalprice").alias("totaldue"))
    )
    return windows.with_group_value(lines, ["city"], city_total=F.sum("totaldue"))


_CARD_SQL = """
    WITH l AS (
        SELECT o_orderkey AS order_num, p_name, p_partkey, c_nationkey AS city, CAST(o_totalprice AS DECIMAL(18,2)) AS totaldue
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey LEFT JOIN customer ON c_custkey = o_custkey
        WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-01'),
    d AS (SELECT *, sum(totaldue) OVER (PARTITION BY city) AS city_total, max(totaldue) OVER (PARTITION BY order_num) AS max_due FROM l)
    SELECT order_num, count(DISTINCT p_name) AS uniq_product_cnt, city,
           round(coalesce(CAST(sum(totaldue) AS DOUBLE) / nullif(CAST(city_total AS DOUBLE), 0), 0), 5) AS city_rate,
           {pick} AS max_due_product,
           string_agg(CAST(p_partkey AS VARCHAR), ', ' ORDER BY p_partkey) AS product_list
    FROM d GROUP BY order_num, city, city_total
"""


@job("q22_order_card_first_max", _CARD_SQL.format(pick="arg_min(p_name, (-totaldue, p_name))"))
def order_card_first(t: Tables) -> DataFrame:
    return _order_lines(t).groupBy("order_num", "city", "city_total").agg(
        F.count_distinct("p_name").alias("uniq_product_cnt"), F.sum("totaldue").alias("due"),
        F.min_by("p_name", F.struct((-F.col("totaldue")).alias("d"), "p_name")).alias("max_due_product"),
        F.expr("listagg(cast(p_partkey AS string), ', ') WITHIN GROUP (ORDER BY p_partkey)").alias("product_list"),
    ).select("order_num", "uniq_product_cnt", "city",
             F.round(numbers.safe_ratio(F.col("due"), F.col("city_total")), 5).alias("city_rate"), "max_due_product", "product_list")


@job("q23_order_card_all_max", _CARD_SQL.format(
    pick="string_agg(p_name, ', ' ORDER BY p_name) FILTER (WHERE totaldue = max_due)"))
def order_card_all(t: Tables) -> DataFrame:
    lines = windows.with_group_value(_order_lines(t), ["order_num"], bounded=True, max_due=F.max("totaldue"))
    return lines.groupBy("order_num", "city", "city_total").agg(
        F.count_distinct("p_name").alias("uniq_product_cnt"), F.sum("totaldue").alias("due"),
        F.expr("listagg(p_name, ', ') WITHIN GROUP (ORDER BY p_name) FILTER (WHERE totaldue = max_due)").alias("max_due_product"),
        F.expr("listagg(cast(p_partkey AS string), ', ') WITHIN GROUP (ORDER BY p_partkey)").alias("product_list"),
    ).select("order_num", "uniq_product_cnt", "city",
             F.round(numbers.safe_ratio(F.col("due"), F.col("city_total")), 5).alias("city_rate"), "max_due_product", "product_list")


@job("q24_abc_classes", """
    WITH a AS (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amt FROM lineitem JOIN orders ON o_orderkey = l_orderkey
               WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY l_partkey),
    r AS (SELECT *, sum(amt) OVER () AS s,
                 sum(amt) OVER (ORDER BY amt DESC, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM a)
    SELECT l_partkey, CAST(amt AS DOUBLE) AS amt,
           CASE WHEN running <= s * 0.8 THEN 'A' WHEN running <= s * 0.95 THEN 'B' ELSE 'C' END AS product_class
    FROM r
""")
def abc_classes(t: Tables) -> DataFrame:
    amounts = _part_amounts(t, "1997-01-01", "1997-12-31")
    order = [F.col("amt").desc(), F.col("l_partkey").asc()]
    running = windows.global_running_sum(amounts, order, F.col("amt"), "running")
    total = amounts.agg(F.sum("amt")).scalar()
    def share(x: str):
        return total * F.lit(x).cast("decimal(3,2)")
    label = F.when(F.col("running") <= share("0.80"), "A").when(F.col("running") <= share("0.95"), "B").otherwise("C")
    return running.select("l_partkey", F.col("amt").cast("double").alias("amt"), label.alias("product_class"))


_DAILY_SQL = """
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS dt, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amt
               FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-07-01' GROUP BY 1),
    w AS (SELECT dt, avg(amt) OVER (ORDER BY dt ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma,
                 amt * 5 + lag(amt, 1, 0) OVER (ORDER BY dt) * 4 + lag(amt, 2, 0) OVER (ORDER BY dt) * 3
                 + lag(amt, 3, 0) OVER (ORDER BY dt) * 2 + lag(amt, 4, 0) OVER (ORDER BY dt) AS top,
                 count(*) OVER (ORDER BY dt ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS n FROM d)
    SELECT dt, round(ma, 4) AS ma_5_days,
           round(top / CASE n WHEN 1 THEN 5 WHEN 2 THEN 9 WHEN 3 THEN 12 WHEN 4 THEN 14 ELSE 15 END, 4) AS weighted_ma_5_days
    FROM w
"""


def _daily(t: Tables) -> DataFrame:
    """One row per day of two months: what follows is ordered over a calendar."""
    kept = t.orders.filter(dates.in_days(F.col("o_orderdate"), "1997-05-01", "1997-06-30"))
    return kept.groupBy(F.to_date("o_orderdate").alias("dt")).agg(exact_sum("o_totalprice").alias("amt"))


def _averages(t: Tables, impl: str) -> DataFrame:
    with_mean = windows.moving_mean(_daily(t), ["dt"], F.col("amt"), 5, "ma")
    both = windows.weighted_ma(with_mean, ["dt"], "amt", [5, 4, 3, 2, 1], impl, "wma")
    return both.select("dt", F.round("ma", 4).alias("ma_5_days"), F.round("wma", 4).alias("weighted_ma_5_days")).orderBy("dt")


@job("q25_weighted_average_by_lags", _DAILY_SQL)
def weighted_by_lags(t: Tables) -> DataFrame:
    return _averages(t, "lag")


@job("q26_weighted_average_by_arrays", _DAILY_SQL)
def weighted_by_arrays(t: Tables) -> DataFrame:
    return _averages(t, "array")


@job("q27_open_and_finished_counts", """
    WITH f AS (SELECT least(o_orderdate, l_shipdate) AS a, greatest(o_orderdate, l_shipdate) AS b
               FROM orders JOIN lineitem ON l_orderkey = o_orderkey
               WHERE o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1997-03-01'),
    p AS (SELECT DISTINCT a AS start_ts, b AS stop_ts FROM f),
    air AS (SELECT start_ts, stop_ts, count(*) AS n FROM f JOIN p ON start_ts <= b AND stop_ts >= a AND stop_ts < b GROUP BY ALL),
    fin AS (SELECT start_ts, stop_ts, count(*) AS n FROM f JOIN p ON start_ts > b GROUP BY ALL)
    SELECT coalesce(air.start_ts, fin.start_ts) AS start_ts, coalesce(air.stop_ts, fin.stop_ts) AS stop_ts,
           coalesce(air.n, 0) AS in_air, coalesce(fin.n, 0) AS finished
    FROM air FULL JOIN fin ON air.start_ts = fin.start_ts AND air.stop_ts = fin.stop_ts
""")
def open_and_finished(t: Tables) -> DataFrame:
    orders = t.orders.filter(dates.in_days(F.col("o_orderdate"), "1997-02-01", "1997-02-28"))
    spans = orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.least("o_orderdate", "l_shipdate").alias("start_ts"), F.greatest("o_orderdate", "l_shipdate").alias("stop_ts"))
    return interval_counts(spans, "start_ts", "stop_ts")


@job("q28_hours_with_running_totals", """
    WITH h AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-10 23:00:00', INTERVAL 1 HOUR)) AS from_ts),
    c AS (SELECT from_ts, CAST(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT) AS cnt,
                 CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS cancel_cnt
          FROM h LEFT JOIN events ON ts >= from_ts AND ts < from_ts + INTERVAL 1 HOUR GROUP BY from_ts)
    SELECT from_ts + INTERVAL 1 HOUR AS to_ts, CAST(sum(cnt) OVER w AS BIGINT) AS cum_cnt, cnt, CAST(sum(cancel_cnt) OVER w AS BIGINT) AS cum_cancel_cnt
    FROM c WINDOW w AS (ORDER BY from_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def hours_with_running_totals(t: Tables) -> DataFrame:
    spine = bucket_spine(t.spark, "2024-01-10", "2024-01-11")
    day = t.events.filter(dates.in_days(F.col("ts"), "2024-01-10", "2024-01-10"))
    hours = left_bucket_join(spine, day, "ts", {
        "cnt": F.count_if(F.col("event_type") != "error"), "cancel_cnt": F.count_if(F.col("event_type") == "error")})
    hours = hours.fillna(0, ["cnt", "cancel_cnt"])
    w = Window.orderBy("from_ts").rowsBetween(Window.unboundedPreceding, 0)
    return hours.select((F.col("from_ts") + F.expr("INTERVAL 1 HOUR")).alias("to_ts"), F.sum("cnt").over(w).alias("cum_cnt"), "cnt",
                        F.sum("cancel_cnt").over(w).alias("cum_cancel_cnt"))


@job("q29_first_row_comment", """
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey = min(c_custkey) OVER (ORDER BY c_custkey) THEN 'all customers' END AS comment
    FROM customer
""")
def first_row_comment(t: Tables) -> DataFrame:
    return windows.first_row_marker(t.customer, "c_custkey", "all customers").select("c_custkey", "c_name", "c_nationkey", "comment")
