"""Join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import exact_mean, exact_sum
from tidewater.operators import joins, patterns, ranges, sets
from tidewater.registry import job
from tidewater.tables import Tables


@job("jn01_inner_star", """
    SELECT r_name, p_type, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amt
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL
""")
def inner_star(t: Tables) -> DataFrame:
    place = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).join(
        t.region, F.col("r_regionkey") == F.col("n_regionkey")).select("s_suppkey", "r_name")
    lines = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).join(place, F.col("s_suppkey") == F.col("l_suppkey"))
    return lines.groupBy("r_name", "p_type").agg(F.count(F.lit(1)).alias("lines"), exact_sum("l_extendedprice").alias("amt"))


@job("jn02_differing_key_names", "SELECT c_custkey, c_nationkey, n_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def differing_keys(t: Tables) -> DataFrame:
    return joins.equi_join(t.customer, t.nation, {"c_nationkey": "n_nationkey"}).select("c_custkey", "c_nationkey", "n_nationkey", "n_name")


@job("jn03_left", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'")
def left(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return joins.equi_join(t.customer, urgent, {"c_custkey": "o_custkey"}, "left").select("c_custkey", "o_orderkey")


@job("jn04_right", "SELECT c_custkey, o_orderkey FROM (SELECT * FROM customer WHERE c_acctbal > 0) RIGHT JOIN orders ON o_custkey = c_custkey")
def right(t: Tables) -> DataFrame:
    return joins.equi_join(t.customer.filter("c_acctbal > 0"), t.orders, {"c_custkey": "o_custkey"}, "right").select("c_custkey", "o_orderkey")


@job("jn05_full_with_coalesced_keys", """
    WITH a AS (SELECT l_shipdate AS d, count(*) AS shipped FROM lineitem WHERE l_quantity > 45 GROUP BY 1),
    b AS (SELECT o_orderdate AS d, count(*) AS ordered FROM orders WHERE o_totalprice > 400000 GROUP BY 1)
    SELECT coalesce(a.d, b.d) AS d, coalesce(shipped, 0) AS shipped, coalesce(ordered, 0) AS ordered FROM a FULL JOIN b ON a.d = b.d
""")
def full_coalesced(t: Tables) -> DataFrame:
    a = t.lineitem.filter("l_quantity > 45").groupBy(F.col("l_shipdate").alias("d")).agg(F.count(F.lit(1)).alias("shipped"))
    b = t.orders.filter("o_totalprice > 400000").groupBy(F.col("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("ordered"))
    return joins.full_with_keys(a, b, ["d"]).fillna(0, ["shipped", "ordered"])


@job("jn06_one_row_aggregate_beside_rows", """
    SELECT o_orderkey, round(o_totalprice / m, 6) AS ratio FROM orders, (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m FROM orders)
""")
def one_row_aggregate(t: Tables) -> DataFrame:
    beside = joins.with_scalars(t.orders, t.orders, m=exact_mean("o_totalprice"))
    return beside.select("o_orderkey", F.round(F.col("o_totalprice") / F.col("m"), 6).alias("ratio"))


@job("jn07_nearest_of_small_groups", """
    WITH g AS (SELECT c_mktsegment, c_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m FROM customer GROUP BY ALL),
    k AS (SELECT c_mktsegment || '/' || c_nationkey AS grp, m FROM g)
    SELECT s_suppkey, arg_min(grp, (abs(s_acctbal - m), grp)) AS nearest_grp FROM supplier, k GROUP BY s_suppkey
""")
def nearest_of_groups(t: Tables) -> DataFrame:
    g = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(exact_mean("c_acctbal").alias("m"))
    g = g.select(F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("grp"), "m")
    return ranges.nearest_group(t.supplier, g, "s_acctbal", "grp", "m", "s_suppkey").select("s_suppkey", "nearest_grp")


@job("jn08_left_join_to_time_spine", """
    WITH h AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-01 23:00:00', INTERVAL 1 HOUR)) AS from_ts)
    SELECT from_ts, count(event_id) AS cnt FROM h LEFT JOIN events ON ts >= from_ts AND ts < from_ts + INTERVAL 1 HOUR GROUP BY 1
""")
def left_to_spine(t: Tables) -> DataFrame:
    spine = ranges.bucket_spine(t.spark, "2023-12-31", "2024-02-02")
    return ranges.left_bucket_join(spine, t.events, "ts", {"cnt": F.count("event_id")}).fillna(0, ["cnt"])


@job("jn09_interval_counts", """
    WITH f AS (SELECT least(o_orderdate, l_shipdate) AS a, greatest(o_orderdate, l_shipdate) AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
    p AS (SELECT DISTINCT a AS start_ts, b AS stop_ts FROM f),
    t AS (SELECT t, sum(o) OVER w AS opened, sum(c) OVER w AS closed, c FROM (
            SELECT t, sum(o) AS o, sum(c) AS c FROM (SELECT a AS t, 1 AS o, 0 AS c FROM f UNION ALL SELECT b, 0, 1 FROM f) GROUP BY t)
          WINDOW w AS (ORDER BY t))
    SELECT start_ts, stop_ts, CAST(e.opened - e.closed AS BIGINT) AS in_air, CAST(s.closed - s.c AS BIGINT) AS finished
    FROM p JOIN t e ON e.t = stop_ts JOIN t s ON s.t = start_ts WHERE e.opened - e.closed > 0 OR s.closed - s.c > 0
""")
def interval_counts(t: Tables) -> DataFrame:
    spans = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.least("o_orderdate", "l_shipdate").alias("start_ts"), F.greatest("o_orderdate", "l_shipdate").alias("stop_ts"))
    return ranges.interval_counts(spans, "start_ts", "stop_ts")


@job("jn11_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def semi(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.filter("o_totalprice > 450000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@job("jn12_anti_keys", "SELECT DISTINCT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def anti(t: Tables) -> DataFrame:
    return joins.anti_keys(t.customer, "c_custkey", t.orders.filter("o_totalprice > 300000"), "o_custkey")


@job("jn13_name_pattern_rules", r"""
    SELECT p_partkey, p_name, coalesce(
        (SELECT action FROM (VALUES ('blue bolt', 'Skip'), ('% ring', 'Copy with data'), ('% bo_t', 'Skip'), ('small %', 'Copy schema')) r(pattern, action)
         WHERE p_name ILIKE pattern ORDER BY (contains(pattern, '%') OR contains(pattern, '_')), -length(pattern), pattern LIMIT 1), 'none') AS action
    FROM part
""")
def name_rules(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame(
        [("% ring", "Copy with data"), ("% bo_t", "Skip"), ("small %", "Copy schema"), ("blue bolt", "Skip")], "pattern string, action string")
    matched = patterns.match_rules(t.part.select("p_partkey", "p_name"), rules, name="p_name")
    return matched.fillna("none", ["action"])


@job("jn13_rules_as_many_as_names", """
    WITH rules AS (
        SELECT substr(s_name, 1, 17) || '%' AS pattern, 'group ' || min(s_nationkey) AS action FROM supplier GROUP BY 1
        UNION ALL SELECT '%#_____' || substr(s_name, 15) AS pattern, 'one ' || min(s_nationkey) FROM supplier GROUP BY 1
        UNION ALL SELECT '%' || substr(s_name, 16, 2) || '_', 'tail ' || min(s_nationkey) FROM supplier GROUP BY 1
        UNION ALL SELECT lower(s_name), 'own' FROM supplier WHERE s_acctbal > 5000)
    SELECT s_suppkey, s_name, (SELECT action FROM rules WHERE s_name ILIKE pattern
        ORDER BY lower(pattern) <> lower(s_name), -length(pattern), pattern, action LIMIT 1) AS action FROM supplier
""")
def many_rules(t: Tables) -> DataFrame:
    """A rule table that grows with the names: starts, ends, pieces between wildcards, and names spelled out."""
    name, least = F.col("s_name"), F.min("s_nationkey").cast("string")
    start, middle, tail = (F.substring(name, 1, 17), F.substring(name, 15, 99), F.substring(name, 16, 2))
    rules = t.supplier.groupBy(F.concat(start, F.lit("%")).alias("pattern")).agg(F.concat(F.lit("group "), least).alias("action"))
    rules = rules.union(t.supplier.groupBy(F.concat(F.lit("%#_____"), middle)).agg(F.concat(F.lit("one "), least)))
    rules = rules.union(t.supplier.groupBy(F.concat(F.lit("%"), tail, F.lit("_"))).agg(F.concat(F.lit("tail "), least)))
    rules = rules.union(t.supplier.filter("s_acctbal > 5000").select(F.lower(name), F.lit("own")))
    return patterns.match_rules(t.supplier.select("s_suppkey", "s_name"), rules, name="s_name")


@job("jn10_parameter_row_range", """
    WITH par AS (SELECT DATE '1997-03-01' AS from_dt, DATE '1997-05-31' AS to_dt)
    SELECT o_orderkey, o_custkey FROM orders JOIN par ON o_orderdate >= from_dt AND o_orderdate < to_dt + INTERVAL 1 DAY
""")
def parameter_row_range(t: Tables) -> DataFrame:
    """The parameters are one row; as scalar subqueries they become constants of the scan."""
    par = t.spark.sql("SELECT DATE '1997-03-01' AS from_dt, DATE '1997-05-31' AS to_dt")
    stored = t.orders.schema["o_orderdate"].dataType
    first, last = par.select("from_dt").scalar(), par.select("to_dt").scalar()
    inside = (F.col("o_orderdate") >= first.cast(stored)) & (F.col("o_orderdate") < F.date_add(last, 1).cast(stored))
    return t.orders.filter(inside).select("o_orderkey", "o_custkey")


@job("jn14_lateral_unnest", """
    SELECT vec_id, pos, CAST(v AS DOUBLE) AS v FROM (
        SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings)
""")
def lateral_unnest(t: Tables) -> DataFrame:
    cells = t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return cells.select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("double").alias("v"))


@job("jn15_join_of_aggregates", """
    SELECT a.o_custkey, orders, amt FROM (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) a
    JOIN (SELECT c_custkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM customer WHERE c_acctbal > 0 GROUP BY 1) b ON b.c_custkey = a.o_custkey
""")
def join_of_aggregates(t: Tables) -> DataFrame:
    return joins.join_aggregates(t.orders, "o_custkey", {"orders": F.count(F.lit(1))},
                                 t.customer.filter("c_acctbal > 0"), "c_custkey", {"amt": exact_sum("c_acctbal")})


_NULLED = """
    WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer),
    n AS (SELECT CASE WHEN n_nationkey = 3 THEN NULL ELSE n_nationkey END AS nk, n_name FROM nation)
"""


def _nulled_keys(t: Tables) -> tuple[DataFrame, DataFrame]:
    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("k"))
    n = t.nation.select(F.when(F.col("n_nationkey") != 3, F.col("n_nationkey")).alias("nk"), "n_name")
    return c, n


@job("jn16_null_keys_do_not_match", _NULLED + "SELECT c_custkey, n_name FROM c LEFT JOIN n ON k = nk")
def null_keys_sql(t: Tables) -> DataFrame:
    c, n = _nulled_keys(t)
    return joins.equi_join(c, n, {"k": "nk"}, "left").select("c_custkey", "n_name")


@job("jn16_null_keys_match_on_request", _NULLED + "SELECT c_custkey, n_name FROM c LEFT JOIN n ON k IS NOT DISTINCT FROM nk")
def null_keys_match(t: Tables) -> DataFrame:
    c, n = _nulled_keys(t)
    return joins.equi_join(c, n, {"k": "nk"}, "left", match_nulls=True).select("c_custkey", "n_name")


@job("jn17_concat_by_row_position", """
    SELECT coalesce(a.rn, b.rn) AS row_no, c_custkey, s_suppkey FROM
    (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS rn FROM customer) a
    FULL JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS rn FROM supplier) b ON a.rn = b.rn
""")
def concat_by_position(t: Tables) -> DataFrame:
    both = sets.concat_columns(t.customer, t.supplier, [F.col("c_acctbal"), F.col("c_custkey")], [F.col("s_acctbal"), F.col("s_suppkey")])
    return both.select("row_no", "c_custkey", "s_suppkey")
