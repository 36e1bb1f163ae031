"""Ordered-calculation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater import staging
from tidewater.functions.numbers import exact_sum, money
from tidewater.operators import ordering, windows
from tidewater.operators.windows import Scan, scan_along
from tidewater.registry import job
from tidewater.tables import Tables

_LINE = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_LINE_COLS = _LINE.split(", ")


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select(*_LINE_COLS)


@job("wn01_dense_rank_cut", """
    SELECT o_orderkey, o_totalprice, r FROM (SELECT *, dense_rank() OVER (ORDER BY o_totalprice DESC) AS r FROM orders) WHERE r <= 10
""")
def dense_rank_cut(t: Tables) -> DataFrame:
    return ordering.top_k_with_ties(t.orders, "o_totalprice", 10, rank_col="r").select("o_orderkey", "o_totalprice", "r")


@job("wn02_dense_rank_of_aggregate", """
    SELECT l_suppkey, cnt, r FROM (SELECT l_suppkey, count(*) AS cnt, dense_rank() OVER (ORDER BY count(*) DESC) AS r FROM lineitem GROUP BY 1) WHERE r <= 5
""")
def dense_rank_of_aggregate(t: Tables) -> DataFrame:
    counted = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("cnt"))
    return ordering.top_k_with_ties(counted, "cnt", 5, rank_col="r")


@job("wn03_month_islands", """
    WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS mn FROM orders WHERE month(o_orderdate) NOT IN (6, 11)),
    g AS (SELECT mn, mn - INTERVAL 1 MONTH * row_number() OVER (ORDER BY mn) AS gid FROM m)
    SELECT min(mn) AS from_month, max(mn) AS to_month, count(*) AS months FROM g GROUP BY gid
""")
def month_islands(t: Tables) -> DataFrame:
    months = t.orders.filter(~F.month("o_orderdate").isin(6, 11)).select(F.trunc("o_orderdate", "month").alias("mn")).distinct()
    return windows.islands(months, "mn").groupBy("island_id").agg(
        F.min("mn").alias("from_month"), F.max("mn").alias("to_month"), F.count(F.lit(1)).alias("months")).drop("island_id")


@job("wn04_first_value_by_condition", """
    SELECT l_orderkey, l_partkey, l_linenumber, first_value(l_extendedprice) OVER (
        PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS lead_price FROM lineitem
""")
def first_value_by_condition(t: Tables) -> DataFrame:
    order = F.struct((F.col("l_returnflag") != "R").alias("f"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    beside = windows.with_group_value(t.lineitem, ["l_orderkey"], bounded=True, _s=F.min(order))
    return beside.select("l_orderkey", "l_partkey", "l_linenumber", F.col("_s.l_extendedprice").alias("lead_price"))


@job("wn05_lag_with_default", """
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS dt, count(*) AS cnt FROM orders GROUP BY 1)
    SELECT dt, cnt, cnt - lag(cnt, 1, cnt) OVER (ORDER BY dt) AS diff, coalesce(lag(cnt, 4) OVER (ORDER BY dt), 0) AS four_back FROM d
""")
def lag_with_default(t: Tables) -> DataFrame:
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("dt")).agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.orderBy("dt")  # one row per calendar day
    return d.select("dt", "cnt", (F.col("cnt") - F.coalesce(F.lag("cnt").over(w), F.col("cnt"))).alias("diff"),
                    F.coalesce(F.lag("cnt", 4).over(w), F.lit(0).cast("long")).alias("four_back"))


@job("wn05_previous_event_of_user", """
    SELECT event_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events
""")
def previous_event(t: Tables) -> DataFrame:
    return windows.previous_row(t.events, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("value"), "previous").select("event_id", "previous")


@job("wn06_running_sum_per_key", """
    SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM events
""")
def running_sum_per_key(t: Tables) -> DataFrame:
    got = windows.global_running_sum(t.events, [F.col("ts"), F.col("event_id")], money("value"), "r", ["event_type"])
    return got.select("event_id", F.col("r").cast("double").alias("running"))


@job("wn07_moving_average", """
    WITH d AS (SELECT CAST(l_shipdate AS DATE) AS dt, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM lineitem GROUP BY 1)
    SELECT dt, round(avg(amt) OVER (ORDER BY dt ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 3) AS ma FROM d
""")
def moving_average(t: Tables) -> DataFrame:
    d = t.lineitem.groupBy(F.to_date("l_shipdate").alias("dt")).agg(exact_sum("l_extendedprice").alias("amt"))
    return windows.moving_mean(d, ["dt"], F.col("amt"), 5, "ma").select("dt", F.round("ma", 3).alias("ma"))


_WMA = """
    WITH d AS (SELECT CAST(l_shipdate AS DATE) AS dt, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM lineitem GROUP BY 1),
    w AS (SELECT dt, amt * 5 + lag(amt, 1, 0) OVER o * 4 + lag(amt, 2, 0) OVER o * 3 + lag(amt, 3, 0) OVER o * 2 + lag(amt, 4, 0) OVER o AS top,
                 row_number() OVER o AS n FROM d WINDOW o AS (ORDER BY dt))
    SELECT dt, round(top / CASE n WHEN 1 THEN 5 WHEN 2 THEN 9 WHEN 3 THEN 12 WHEN 4 THEN 14 ELSE 15 END, 3) AS wma FROM w
"""


def _wma(t: Tables, impl: str) -> DataFrame:
    d = t.lineitem.groupBy(F.to_date("l_shipdate").alias("dt")).agg(exact_sum("l_extendedprice").alias("amt"))
    return windows.weighted_ma(d, ["dt"], "amt", [5, 4, 3, 2, 1], impl, "wma").select("dt", F.round("wma", 3).alias("wma"))


@job("wn08_weighted_average_lags", _WMA)
def weighted_lags(t: Tables) -> DataFrame:
    return _wma(t, "lag")


@job("wn09_weighted_average_arrays", _WMA)
def weighted_arrays(t: Tables) -> DataFrame:
    return _wma(t, "array")


@job("wn10_frame_count", """
    SELECT dt, count(*) OVER (ORDER BY dt ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS n FROM (SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events)
""")
def frame_count(t: Tables) -> DataFrame:
    d = t.events.select(F.to_date("ts").alias("dt")).distinct()
    return windows.frame_count(d, ["dt"], 5, "n")


# The lines of the whole table as one series, and one series per supplier.
@job("wn07_moving_average_of_lines", f"""
    SELECT l_orderkey, l_linenumber,
           round(avg(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (ORDER BY {_LINE} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 3) AS ma,
           count(*) OVER (ORDER BY {_LINE} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS n FROM lineitem
""")
def moving_average_of_lines(t: Tables) -> DataFrame:
    lines = _lines(t).withColumn("price", money("l_extendedprice"))
    order = [F.col(c) for c in _LINE_COLS]
    got = staging.frames_along(lines, order, {
        "top": lambda w: F.sum("price").over(w.rowsBetween(-4, 0)), "n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-4, 0))}, before=4)
    return got.select("l_orderkey", "l_linenumber", F.round(F.col("top").cast("double") / F.col("n"), 3).alias("ma"), "n")


@job("wn08_weighted_average_per_supplier", f"""
    WITH w AS (SELECT l_orderkey, l_linenumber, l_extendedprice * 5 + lag(l_extendedprice, 1, 0) OVER o * 4 + lag(l_extendedprice, 2, 0) OVER o * 3
                      + lag(l_extendedprice, 3, 0) OVER o * 2 + lag(l_extendedprice, 4, 0) OVER o AS top, row_number() OVER o AS n
               FROM lineitem WINDOW o AS (PARTITION BY l_suppkey ORDER BY {_LINE}))
    SELECT l_orderkey, l_linenumber, round(top / CASE n WHEN 1 THEN 5 WHEN 2 THEN 9 WHEN 3 THEN 12 WHEN 4 THEN 14 ELSE 15 END, 3) AS wma FROM w
""")
def weighted_average_per_supplier(t: Tables) -> DataFrame:
    got = windows.weighted_ma(_lines(t), _LINE_COLS, "l_extendedprice", [5, 4, 3, 2, 1], out="wma", partition_by=["l_suppkey"])
    return got.select("l_orderkey", "l_linenumber", F.round("wma", 3).alias("wma"))


@job("wn10_frame_count_per_user", """
    SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n FROM events
""")
def frame_count_per_user(t: Tables) -> DataFrame:
    return windows.frame_count(t.events.select("event_id", "user_id", "ts"), ["ts", "event_id"], 7, "n", ["user_id"]).select("event_id", "n")


@job("wn11_group_values_beside_rows", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS order_sum,
           max(l_quantity) OVER w AS max_qty, count(*) OVER w AS lines FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)
""")
def group_values(t: Tables) -> DataFrame:
    return windows.with_group_value(t.lineitem, ["l_orderkey"], bounded=True, order_sum=F.sum(F.col("l_extendedprice").cast("decimal(18,2)")), max_qty=F.max("l_quantity"),
                                    lines=F.count(F.lit(1))).select("l_orderkey", "l_linenumber", "l_partkey", F.col("order_sum").cast("double").alias("order_sum"), "max_qty", "lines")


@job("wn12_rank_in_group", "SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS r FROM part")
def rank_in_group(t: Tables) -> DataFrame:
    # Equal sizes are merged first: the rank is 1 + the rows of larger sizes, carried over distinct values.
    sizes = t.part.groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))
    ranked = scan_along(sizes, [F.col("p_size").desc()], {"upto": Scan("sum", F.col("n"))}, ["p_brand"])
    ranks = ranked.select(F.col("p_brand").alias("b"), F.col("p_size").alias("s"), (F.col("upto") - F.col("n") + 1).alias("r"))
    return t.part.join(ranks, (F.col("p_brand") == F.col("b")) & (F.col("p_size") == F.col("s"))).select("p_partkey", "r")


@job("wn13_first_row_marker", "SELECT s_suppkey, CASE WHEN s_suppkey = min(s_suppkey) OVER (ORDER BY s_suppkey) THEN 'first' END AS comment FROM supplier")
def first_row_marker(t: Tables) -> DataFrame:
    return windows.first_row_marker(t.supplier, "s_suppkey", "first").select("s_suppkey", "comment")


@job("wn14_global_running_sum", f"""
    SELECT {_LINE}, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (ORDER BY {_LINE} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM lineitem
""")
def global_running_sum(t: Tables) -> DataFrame:
    got = windows.global_running_sum(_lines(t), [F.col(c) for c in _LINE_COLS], money("l_extendedprice"), "r")
    return got.select(*_LINE_COLS, F.col("r").cast("double").alias("running"))


@job("wn14_global_row_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders")
def global_row_number(t: Tables) -> DataFrame:
    return windows.global_row_number(t.orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], "rn").select("o_orderkey", "rn")


@job("wn15_chain_length", """
    WITH l AS (SELECT conv_id, turn, text, lag(text) OVER w AS p, row_number() OVER w AS rn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, coalesce(min(rn) FILTER (WHERE p IS NOT NULL AND NOT coalesce(left(text, 1) = right(p, 1) AND length(text) = length(p) + 1, false)) - 1, max(rn)) AS run_length
    FROM l GROUP BY 1
""")
def chain_length(t: Tables) -> DataFrame:
    return windows.run_until_break(t.conversations, ["conv_id"], "turn", "text")


_GAPPY = "SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM events"


def _gappy(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v"))


@job("wn16_fill_forward", f"""
    SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v FROM ({_GAPPY})
""")
def fill_forward(t: Tables) -> DataFrame:
    return windows.fill_along(_gappy(t), ["user_id"], ["ts", "event_id"], ["v"]).select("event_id", "v")


@job("wn16_fill_backward", f"""
    SELECT event_id, last_value(v IGNORE NULLS) OVER (ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS v FROM ({_GAPPY})
""")
def fill_backward(t: Tables) -> DataFrame:
    return windows.fill_along(_gappy(t), [], ["ts", "event_id"], ["v"], "backward").select("event_id", "v")


_WEIGHTS = windows.gaussian_weights(2.0)


@job("wn17_gaussian_smooth", f"""
    WITH s AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn,
                      count(*) OVER (PARTITION BY event_type) AS n FROM events),
    o AS (SELECT unnest(range(-8, 9)) AS o, unnest([{', '.join(f'{w!r}::DOUBLE' for w in _WEIGHTS)}]) AS w),
    p AS (SELECT s.event_type, s.event_id, w, o, rn + o AS p, n FROM s, o),
    r AS (SELECT *, CASE WHEN p < 1 THEN 1 - p WHEN p > n THEN 2 * n + 1 - p ELSE p END AS q FROM p)
    SELECT r.event_id, round(sum(r.w * s.value), 5) AS smooth FROM r JOIN s ON s.event_type = r.event_type AND s.rn = r.q GROUP BY 1
""")
def gaussian_smooth(t: Tables) -> DataFrame:
    got = windows.gaussian_smooth(t.events, ["event_type"], ["ts", "event_id"], "value", 2.0, chunk=500)
    return got.select("event_id", F.round("smooth", 5).alias("smooth"))
