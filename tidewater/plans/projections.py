"""Projection, filter, ordering and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import arrays, dates, numbers
from tidewater.operators import ordering, sets
from tidewater.registry import job
from tidewater.tables import Tables


@job("pj01_select_drop_rename_compute", """
    SELECT l_orderkey AS order_id, l_partkey, l_quantity, round(l_extendedprice * (1 - l_discount), 4) AS net_price FROM lineitem
""")
def select_drop_rename(t: Tables) -> DataFrame:
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    return (t.lineitem.withColumn("net_price", net).withColumnRenamed("l_orderkey", "order_id")
            .select("order_id", "l_partkey", "l_quantity", "net_price", "l_tax").drop("l_tax", "no_such_column"))


def columns_of_type(df: DataFrame, *kinds: str) -> list[str]:
    """Names of the columns whose simple type starts with one of `kinds`."""
    return [n for n, k in df.dtypes if k.startswith(kinds)]


NUMERIC = ("int", "bigint", "double", "float", "decimal", "smallint", "tinyint")


@job("pj02_select_by_type", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
""")
def select_by_type(t: Tables) -> DataFrame:
    return t.lineitem.select(*columns_of_type(t.lineitem, *NUMERIC))


@job("pj02_select_text_columns", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def select_text_columns(t: Tables) -> DataFrame:
    return t.lineitem.select(*columns_of_type(t.lineitem, "string", "boolean")).distinct()


@job("pj03_prefix_row_sum_and_largest", """
    WITH s AS (SELECT *, round(l_quantity + l_extendedprice + l_discount + l_tax, 4) AS total FROM lineitem)
    SELECT l_orderkey, l_partkey, l_linenumber, total FROM s WHERE total = (SELECT max(total) FROM s)
""")
def prefix_row_sum(t: Tables) -> DataFrame:
    cols = [c for c in columns_of_type(t.lineitem, "double") if c.startswith("l_")]
    summed = t.lineitem.withColumn("total", F.round(numbers.row_sum(cols), 4))
    top = summed.agg(F.max("total")).scalar()
    return summed.filter(F.col("total") == top).select("l_orderkey", "l_partkey", "l_linenumber", "total")


@job("pj04_and_or_not", """
    SELECT o_orderkey FROM orders WHERE (o_totalprice > 200000 OR o_orderpriority = '1-URGENT') AND NOT (o_orderstatus = 'F')
""")
def and_or_not(t: Tables) -> DataFrame:
    wanted = ((F.col("o_totalprice") > 200000) | (F.col("o_orderpriority") == "1-URGENT")) & ~(F.col("o_orderstatus") == "F")
    return t.orders.filter(wanted).select("o_orderkey")


@job("pj05_between_inclusive", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 5 AND 15")
def between_inclusive(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_size").between(5, 15)).select("p_partkey", "p_size")


@job("pj06_half_open_days", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-03-31' + INTERVAL 1 DAY
""")
def half_open_days(t: Tables) -> DataFrame:
    return t.orders.filter(dates.in_days(F.col("o_orderdate"), "1997-03-01", "1997-03-31")).select("o_orderkey", "o_orderdate")


@job("pj07_in_list", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def in_list(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")


@job("pj08_in_subquery", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def in_subquery(t: Tables) -> DataFrame:
    big = t.lineitem.filter("l_quantity > 45")
    return t.orders.join(big, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@job("pj09_column_differs_from_column", "SELECT c_custkey FROM customer WHERE c_nationkey <> c_custkey % 25")
def column_differs(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_nationkey") != F.col("c_custkey") % 25).select("c_custkey")


@job("pj10_pattern_from_column", "SELECT p_partkey FROM part WHERE p_name ILIKE '%' || substr(p_type, 1, 3) || '%'")
def pattern_from_column(t: Tables) -> DataFrame:
    return t.part.filter("p_name ILIKE concat('%', substr(p_type, 1, 3), '%')").select("p_partkey")


@job("pj11_null_tests", """
    WITH n AS (SELECT nullif(l_discount, 0.0) AS d, nullif(l_tax, 0.0) AS x FROM lineitem)
    SELECT count(*) FILTER (WHERE d IS NULL) AS no_discount, count(*) FILTER (WHERE d IS NOT NULL AND x IS NULL) AS discount_no_tax FROM n
""")
def null_tests(t: Tables) -> DataFrame:
    n = t.lineitem.select(F.nullif("l_discount", F.lit(0.0)).alias("d"), F.nullif("l_tax", F.lit(0.0)).alias("x"))
    return n.agg(F.count_if(F.col("d").isNull()).alias("no_discount"),
                 F.count_if(F.col("d").isNotNull() & F.col("x").isNull()).alias("discount_no_tax"))


@job("pj12_is_true", """
    SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE (l.quality = 1) IS TRUE
""")
def is_true(t: Tables) -> DataFrame:
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return both.filter((F.col("quality") == 1).eqNullSafe(F.lit(True))).select("doc_id")


@job("pj13_query_text", "SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000 AND s_nationkey < 10")
def query_text(t: Tables) -> DataFrame:
    return t.supplier.filter("s_acctbal > 1000 and s_nationkey < 10").select("s_suppkey")


@job("pj14_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@job("pj15_parameter_row", """
    WITH par AS (SELECT DATE '1997-01-01' AS from_dt, DATE '1997-12-31' AS to_dt, 100000.0 AS floor)
    SELECT o_orderkey FROM orders JOIN par ON o_orderdate >= from_dt AND o_orderdate < to_dt + INTERVAL 1 DAY AND o_totalprice >= floor
""")
def parameter_row(t: Tables, first: str = "1997-01-01", last: str = "1997-12-31", floor: float = 100000.0) -> DataFrame:
    return t.orders.filter(dates.in_days(F.col("o_orderdate"), first, last) & (F.col("o_totalprice") >= floor)).select("o_orderkey")


@job("pj16_conditional_update", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 40 THEN 40.0 ELSE l_quantity END AS l_quantity FROM lineitem
""")
def conditional_update(t: Tables) -> DataFrame:
    capped = numbers.where_set(F.col("l_quantity") > 40, F.lit(40.0), F.col("l_quantity"))
    return t.lineitem.withColumn("l_quantity", capped).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@job("pj17_rows_of_one_key", "SELECT * FROM orders WHERE o_custkey = 7")
def rows_of_one_key(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_custkey") == 7)


@job("or01_sort_mixed_with_null_order", """
    SELECT row_number() OVER (ORDER BY flag DESC NULLS FIRST, cnt ASC NULLS LAST, l_linenumber) AS pos, flag, l_linenumber, cnt FROM (
        SELECT nullif(l_returnflag, 'N') AS flag, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY ALL)
""")
def sort_mixed(t: Tables) -> DataFrame:
    counted = t.lineitem.groupBy(F.nullif("l_returnflag", F.lit("N")).alias("flag"), "l_linenumber").agg(F.count(F.lit(1)).alias("cnt"))
    order = [F.col("flag").desc_nulls_first(), F.col("cnt").asc_nulls_last(), F.col("l_linenumber")]
    # A few dozen groups; the position only makes the order visible in the result.
    return counted.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("pos"), "flag", "l_linenumber", "cnt")


@job("or02_first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def first_n(t: Tables) -> DataFrame:
    return t.orders.orderBy("o_orderkey").limit(5).select("o_orderkey", "o_totalprice")


@job("or02_last_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def last_n(t: Tables) -> DataFrame:
    return ordering.last_n(t.orders, ["o_orderkey"], 5).select("o_orderkey", "o_totalprice")


@job("or03_top_k_with_ties", """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, r FROM (
        SELECT *, dense_rank() OVER (ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r <= 3
""")
def top_k_with_ties(t: Tables) -> DataFrame:
    return ordering.top_k_with_ties(t.lineitem, "l_quantity", 3, rank_col="r").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "r")


@job("or04_top_k_no_ties", "SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY 1 ORDER BY cnt DESC, o_custkey LIMIT 10")
def top_k_no_ties(t: Tables) -> DataFrame:
    return ordering.top_keys(t.orders, "o_custkey", 10)


@job("or05_aggregate_of_top_keys", """
    WITH k AS (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 10)
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price FROM orders WHERE o_custkey IN (FROM k) GROUP BY 1
""")
def aggregate_of_top(t: Tables) -> DataFrame:
    return ordering.restrict_to_top(t.orders, "o_custkey", 10).groupBy("o_custkey").agg(
        numbers.exact_mean("o_totalprice").alias("mean_price"))


@job("or06_nth_row_from_end", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1 OFFSET 6")
def nth_row_from_end(t: Tables) -> DataFrame:
    return ordering.nth_row(t.orders, ["o_totalprice", "o_orderkey"], 7, from_end=True).select("o_orderkey", "o_totalprice")


@job("or07_sort_inside_row", """
    SELECT vec_id, CAST(s[1] AS DOUBLE) AS first, CAST(s[2] AS DOUBLE) AS second, CAST(s[-1] AS DOUBLE) AS last
    FROM (SELECT vec_id, list_sort(embedding, 'DESC') AS s FROM embeddings)
""")
def sort_inside_row(t: Tables) -> DataFrame:
    s = t.embeddings.select("vec_id", F.sort_array("embedding", asc=False).alias("s"))
    return s.select("vec_id", F.get("s", F.lit(0)).cast("double").alias("first"), F.get("s", F.lit(1)).cast("double").alias("second"),
                    F.get("s", F.size("s") - 1).cast("double").alias("last"))


@job("or08_position_of_extremes", """
    SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax,
           CAST(list_position(embedding, list_min(embedding)) - 1 AS BIGINT) AS argmin FROM embeddings
""")
def position_of_extremes(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", arrays.argmax(F.col("embedding")).alias("argmax"), arrays.argmin(F.col("embedding")).alias("argmin"))


@job("or09_sort_by_case", """
    SELECT o_orderstatus, o_orderpriority, cnt, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderpriority) AS pos
    FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS cnt FROM orders GROUP BY ALL)
""")
def sort_by_case(t: Tables) -> DataFrame:
    counted = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("cnt"))
    first = F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    return counted.select("o_orderstatus", "o_orderpriority", "cnt",
                          F.row_number().over(Window.orderBy(first, "o_orderpriority")).cast("long").alias("pos"))


@job("st01_union_all_tagged", """
    SELECT 'customer' AS source, c_nationkey AS nation, count(*) AS cnt FROM customer GROUP BY 2
    UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2
""")
def union_tagged(t: Tables) -> DataFrame:
    both = sets.union_tagged({"customer": t.customer.select(F.col("c_nationkey").alias("nation")),
                              "supplier": t.supplier.select(F.col("s_nationkey").alias("nation"))})
    return both.groupBy("source", "nation").agg(F.count(F.lit(1)).alias("cnt"))


@job("st02_union_differing_columns", """
    SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier
""")
def union_differing(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


@job("st03_set_difference", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def set_difference(t: Tables) -> DataFrame:
    big = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").subtract(big)


@job("st04_count_duplicate_texts", """
    SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang)
""")
def count_duplicates(t: Tables) -> DataFrame:
    return sets.count_duplicates(t.documents.select("text", "lang"))


@job("st04_drop_exact_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def drop_exact_duplicates(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber").dropDuplicates()


@job("st05_keep_first_by_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
    WHERE rn = 1
""")
def keep_first(t: Tables) -> DataFrame:
    src = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return sets.keep_first(src, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]).drop("l_shipdate")


@job("st06_union_by_first_seen", """
    SELECT nation, min(seen) AS seen FROM (SELECT c_nationkey AS nation, 0 AS seen FROM customer UNION ALL SELECT s_nationkey, 1 FROM supplier) GROUP BY 1
""")
def union_first_seen(t: Tables) -> DataFrame:
    frames = [t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))]
    return sets.union_first_seen(frames, ["nation"])
