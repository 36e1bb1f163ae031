"""Aggregate queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import numbers, text
from tidewater.functions.numbers import exact_mean, exact_sum, money
from tidewater.operators import aggregates, sets, stats, windows
from tidewater.registry import job
from tidewater.tables import Tables

_SUM = "CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def _dec(c: str) -> str:
    return _SUM.format(c=c)


@job("ag01_basic_by_keys", f"""
    SELECT nullif(l_returnflag, 'N') AS flag, l_linestatus, {_dec('l_quantity')} AS sum_qty, {_dec('l_extendedprice')} / count(*) AS avg_price,
           min(l_discount) AS min_disc, max(l_tax) AS max_tax, count(*) AS cnt
    FROM lineitem GROUP BY ALL
""")
def basic_by_keys(t: Tables) -> DataFrame:
    src = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    return aggregates.group_agg(src, ["flag", "l_linestatus"], {
        "sum_qty": exact_sum("l_quantity"), "avg_price": exact_mean("l_extendedprice"), "min_disc": F.min("l_discount"),
        "max_tax": F.max("l_tax"), "cnt": F.count(F.lit(1))})


@job("ag01_null_group_dropped", """
    SELECT nullif(l_returnflag, 'N') AS flag, count(*) AS cnt FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1
""")
def null_group_dropped(t: Tables) -> DataFrame:
    src = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    return aggregates.group_agg(src, ["flag"], {"cnt": F.count(F.lit(1))}, drop_null_keys=True)


@job("ag02_several_functions_per_column", """
    SELECT o_orderpriority, count(*) AS size, min(o_totalprice) AS lo, max(o_totalprice) AS hi, round(stddev_samp(o_totalprice), 3) AS sd
    FROM orders GROUP BY 1
""")
def several_functions(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("size"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"),
        F.round(F.stddev_samp("o_totalprice"), 3).alias("sd"))


@job("ag03_distinct_count", "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def distinct_count(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"))


@job("ag04_conditional_sum", """
    SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS returned FROM lineitem GROUP BY 1
""")
def conditional_sum(t: Tables) -> DataFrame:
    hit = F.when(F.col("l_returnflag") == "R", money("l_extendedprice")).otherwise(F.lit(0).cast("decimal(18,2)"))
    return t.lineitem.groupBy("l_linestatus").agg(F.sum(hit).cast("double").alias("returned"))


@job("ag05_filtered_aggregate", """
    SELECT l_linenumber, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_discount > 0.09 AND l_quantity > 49.5) AS DOUBLE) AS qty FROM lineitem GROUP BY 1
""")
def filtered_aggregate(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linenumber").agg(
        F.expr("CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_discount > 0.09 AND l_quantity > 49.5) AS DOUBLE)").alias("qty"))


@job("ag06_first_of_ordered_list", """
    SELECT p_type, arg_min(p_name, (-p_retailprice, p_name, p_partkey)) AS name, max(p_retailprice) AS price FROM part GROUP BY 1
""")
def first_of_ordered(t: Tables) -> DataFrame:
    order = F.struct((-F.col("p_retailprice")).alias("p"), "p_name", "p_partkey")
    return t.part.groupBy("p_type").agg(F.min_by("p_name", order).alias("name"), F.max("p_retailprice").alias("price"))


@job("ag07_string_aggregate", "SELECT p_type, string_agg(p_brand, ', ' ORDER BY p_brand) AS brands FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY 1")
def string_aggregate(t: Tables) -> DataFrame:
    pairs = t.part.select("p_type", "p_brand").distinct()
    return pairs.groupBy("p_type").agg(F.expr("listagg(p_brand, ', ') WITHIN GROUP (ORDER BY p_brand)").alias("brands"))


@job("ag08_value_in_both_sets", """
    SELECT c_mktsegment FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1
    HAVING bool_or(n_regionkey = 0 AND c_acctbal > 9500) AND bool_or(n_regionkey = 1 AND c_acctbal > 9500)
""")
def in_both_sets(t: Tables) -> DataFrame:
    rich = F.col("c_acctbal") > 9500
    per = t.customer.join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("c_mktsegment").agg(
        F.bool_or((F.col("n_regionkey") == 0) & rich).alias("a"), F.bool_or((F.col("n_regionkey") == 1) & rich).alias("b"))
    return per.filter("a AND b").select("c_mktsegment")


@job("ag09_having", "SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY 1 HAVING count(*) > 12")
def having(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 12")


@job("ag10_group_by_expression", f"SELECT CAST(round_even(l_quantity / 10, 0) AS BIGINT) AS tens, {_dec('l_extendedprice')} / count(*) AS mean_price FROM lineitem GROUP BY 1")
def group_by_expression(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(numbers.np_round(F.col("l_quantity") / 10).cast("long").alias("tens")).agg(
        exact_mean("l_extendedprice").alias("mean_price"))


@job("ag11_global", f"SELECT count(*) AS cnt, {_dec('o_totalprice')} AS total, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders")
def global_aggregate(t: Tables) -> DataFrame:
    return t.orders.agg(F.count(F.lit(1)).alias("cnt"), exact_sum("o_totalprice").alias("total"),
                        F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))


@job("ag12_value_counts", """
    SELECT flag, count(*) AS cnt FROM (SELECT nullif(o_orderstatus, 'P') AS flag FROM orders) WHERE flag IS NOT NULL GROUP BY 1
""")
def value_counts(t: Tables) -> DataFrame:
    src = t.orders.select(F.nullif("o_orderstatus", F.lit("P")).alias("flag"))
    return stats.value_counts(src, "flag").orderBy(F.col("cnt").desc(), "flag")


@job("ag12_value_shares", """
    SELECT o_orderpriority, round(count(*) / CAST((SELECT count(o_orderpriority) FROM orders) AS DOUBLE), 8) AS share FROM orders GROUP BY 1
""")
def value_shares(t: Tables) -> DataFrame:
    return stats.value_counts(t.orders, "o_orderpriority", normalize=True).select("o_orderpriority", F.round("share", 8).alias("share"))


@job("ag13_least_and_most_frequent", """
    WITH c AS (SELECT event_type AS value, count(*) AS cnt FROM events GROUP BY 1)
    (SELECT 'most' AS which, value, cnt FROM c ORDER BY cnt DESC, value DESC LIMIT 1)
    UNION ALL (SELECT 'least', value, cnt FROM c ORDER BY cnt, value LIMIT 1)
""")
def least_and_most(t: Tables) -> DataFrame:
    most = stats.extreme_value(t.events, "event_type").select(F.lit("most").alias("which"), "value", "cnt")
    return most.unionByName(stats.extreme_value(t.events, "event_type", most=False).select(F.lit("least").alias("which"), "value", "cnt"))


@job("ag14_mode", "SELECT l_quantity AS value FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_quantity LIMIT 1")
def mode(t: Tables) -> DataFrame:
    return stats.mode_value(t.lineitem, "l_quantity")


@job("ag15_pivot_mean_with_total", """
    SELECT o_orderpriority, round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 3) AS "F", round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 3) AS "O",
           round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 3) AS "P", round(avg(o_totalprice), 3) AS total
    FROM orders GROUP BY 1
""")
def pivot(t: Tables) -> DataFrame:
    wide = aggregates.pivot_mean(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"], "o_totalprice", margin="total")
    return wide.select("o_orderpriority", *[F.round(c, 3).alias(c) for c in ("F", "O", "P", "total")])


@job("ag16_two_year_difference", """
    WITH y AS (SELECT o_orderpriority, count(*) FILTER (WHERE year(o_orderdate) = 1999) AS a, count(*) FILTER (WHERE year(o_orderdate) = 2001) AS b
               FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
    SELECT o_orderpriority, a, b, round(CASE WHEN a = 0 THEN 1 ELSE (b - a) / CAST(a AS DOUBLE) * 100 END, 4) AS diff_pct FROM y
""")
def two_year_difference(t: Tables) -> DataFrame:
    y = t.orders.filter("o_orderstatus = 'P'").groupBy("o_orderpriority").agg(
        F.count_if(F.year("o_orderdate") == 1999).alias("a"), F.count_if(F.year("o_orderdate") == 2001).alias("b"))
    diff = F.when(F.col("a") == 0, 1.0).otherwise(F.try_divide(F.col("b") - F.col("a"), F.col("a")) * 100)
    return y.select("o_orderpriority", "a", "b", F.round(diff, 4).alias("diff_pct"))


@job("ag17_unpivot_then_count", """
    SELECT value, count(*) AS cnt FROM (SELECT l_returnflag AS value FROM lineitem UNION ALL SELECT l_linestatus FROM lineitem) GROUP BY 1
""")
def unpivot_count(t: Tables) -> DataFrame:
    long = t.lineitem.select(F.explode(F.array("l_returnflag", "l_linestatus")).alias("value"))
    return stats.value_counts(long, "value")


@job("ag18_median_by_group", "SELECT l_returnflag, round(median(l_extendedprice), 6) AS median_price FROM lineitem GROUP BY 1")
def median_by_group(t: Tables) -> DataFrame:
    got = stats.exact_quantiles(t.lineitem, "l_extendedprice", {"m": 0.5}, by=["l_returnflag"])
    return got.select("l_returnflag", F.round("m", 6).alias("median_price"))


@job("ag19_quantiles", """
    SELECT round(quantile_cont(l_extendedprice, 0.05), 6) AS q05, round(quantile_cont(l_extendedprice, 0.95), 6) AS q95,
           round(quantile_cont(l_extendedprice, 0.995), 6) AS q995 FROM lineitem
""")
def quantiles(t: Tables) -> DataFrame:
    got = stats.exact_quantiles(t.lineitem, "l_extendedprice", {"q05": 0.05, "q95": 0.95, "q995": 0.995})
    return got.select(*[F.round(c, 6).alias(c) for c in got.columns])


@job("ag20_deviations", "SELECT l_linenumber, round(stddev_samp(l_extendedprice), 3) AS sd_sample, round(stddev_pop(l_extendedprice), 3) AS sd_population FROM lineitem GROUP BY 1")
def deviations(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linenumber").agg(
        F.round(F.stddev_samp("l_extendedprice"), 3).alias("sd_sample"), F.round(F.stddev_pop("l_extendedprice"), 3).alias("sd_population"))


@job("ag21_range", "SELECT l_linenumber, round(max(l_extendedprice) - min(l_extendedprice), 4) AS spread FROM lineitem GROUP BY 1")
def value_range(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linenumber").agg(F.round(F.max("l_extendedprice") - F.min("l_extendedprice"), 4).alias("spread"))


@job("ag22_iqr_by_group", "SELECT event_type, round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr FROM events GROUP BY 1")
def iqr_by_group(t: Tables) -> DataFrame:
    q = stats.exact_quantiles(t.events, "value", {"a": 0.25, "b": 0.75}, by=["event_type"])
    return q.select("event_type", F.round(F.col("b") - F.col("a"), 6).alias("iqr"))


_DESCRIBE = """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
    round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""


@job("ag23_describe_numeric", " UNION ALL ".join(_DESCRIBE.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def describe_numeric(t: Tables) -> DataFrame:
    d = stats.describe_numeric(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"])
    return d.select("column", "count", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 4).alias(c) for c in ("q25", "q50", "q75")], "max")


_DESCRIBE_TEXT = """SELECT * FROM (SELECT '{c}' AS "column", CAST(sum(n) OVER () AS BIGINT) AS count, count(*) OVER () AS "unique", v AS top, n AS freq
    FROM (SELECT {c} AS v, count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, v LIMIT 1)"""


@job("ag24_describe_text", " UNION ALL ".join(_DESCRIBE_TEXT.format(c=c) for c in ("o_orderstatus", "o_orderpriority")))
def describe_text(t: Tables) -> DataFrame:
    return stats.describe_text(t.orders, ["o_orderstatus", "o_orderpriority"])


@job("ag25_count_if", "SELECT count(*) FILTER (WHERE p_size > 25) AS big, count(*) FILTER (WHERE p_name LIKE 'red%') AS red FROM part")
def count_if(t: Tables) -> DataFrame:
    return t.part.agg(F.count_if(F.col("p_size") > 25).alias("big"), F.count_if(F.col("p_name").startswith("red")).alias("red"))


@job("ag26_rows_at_maximum", "SELECT p_partkey, p_size FROM part WHERE p_size = (SELECT max(p_size) FROM part)")
def rows_at_maximum(t: Tables) -> DataFrame:
    return aggregates.rows_at_extreme(t.part, "p_size").select("p_partkey", "p_size")


@job("ag26_count_at_minimum", "SELECT count(*) AS cnt FROM part WHERE p_size = (SELECT min(p_size) FROM part)")
def count_at_minimum(t: Tables) -> DataFrame:
    return aggregates.rows_at_extreme(t.part, "p_size", largest=False).agg(F.count(F.lit(1)).alias("cnt"))


@job("ag27_proportion", """
    SELECT c_mktsegment, floor(avg(CASE WHEN c_acctbal > 5000 THEN 1.0::DOUBLE ELSE 0 END) * 100 + 0.5) / 100 AS share FROM customer GROUP BY 1
""")
def proportion(t: Tables) -> DataFrame:
    share = F.avg((F.col("c_acctbal") > 5000).cast("double"))
    return t.customer.groupBy("c_mktsegment").agg(numbers.round_half_up(share, 2).alias("share"))


@job("ag28_words_in_all_languages", r"""
    SELECT item FROM (SELECT DISTINCT lang, unnest(string_split_regex(text, '\s+')) AS item FROM documents) WHERE item <> ''
    GROUP BY item HAVING count(DISTINCT lang) = 4
""")
def words_in_all(t: Tables) -> DataFrame:
    src = t.documents.select("lang", text.words(F.col("text")).alias("items"))
    return sets.in_all_lists(src, "lang", "items", 4)


@job("ag29_weighted_sum", """
    SELECT l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS weighted,
           round_even(CAST(sum(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE), 0) AS rounded
    FROM lineitem GROUP BY 1
""")
def weighted_sum(t: Tables) -> DataFrame:
    s = F.sum(money("l_quantity") * money("l_discount")).cast("double")
    return t.lineitem.groupBy("l_returnflag").agg(s.alias("weighted"), F.rint(s).alias("rounded"))


@job("ag30_share_of_group_total", f"""
    WITH s AS (SELECT c_nationkey, c_custkey, c_acctbal, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) OVER (PARTITION BY c_nationkey) AS DOUBLE) AS total FROM customer)
    SELECT c_custkey, round(coalesce(c_acctbal / nullif(total, 0), 0), 8) AS share FROM s
""")
def share_of_group(t: Tables) -> DataFrame:
    beside = windows.with_group_value(t.customer, ["c_nationkey"], total=exact_sum("c_acctbal"))
    return beside.select("c_custkey", F.round(numbers.safe_ratio(F.col("c_acctbal"), F.col("total")), 8).alias("share"))


@job("ag31_member_list_line", """
    SELECT p_type, p_type || ' (' || count(*) || '): ' || string_agg(p_brand, ', ' ORDER BY p_brand) || '.' AS line
    FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY p_type
""")
def member_list(t: Tables) -> DataFrame:
    return aggregates.member_lists(t.part, "p_type", "p_brand")


@job("ag32_arg_max_row", """
    SELECT p_brand, p_partkey, p_name, p_retailprice FROM (
        SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = 1
""")
def arg_max_row(t: Tables) -> DataFrame:
    src = t.part.select("p_brand", "p_partkey", "p_name", "p_retailprice")
    return aggregates.arg_max_row(src, ["p_brand"], "p_retailprice", "p_partkey")
