"""Distribution-summary queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import exact_mean, exact_sum
from tidewater.operators import distributions, features, sets, stats
from tidewater.registry import job
from tidewater.tables import Tables

_HIST = """
    WITH s AS (SELECT min({c}) AS lo, max({c}) AS hi, {k} AS k FROM {t}),
    b AS (SELECT {g} least(CAST(floor(({c} - lo) / (hi - lo) * k) AS BIGINT), k - 1) AS bin, count(*) AS cnt FROM {t}, s GROUP BY ALL),
    sp AS (SELECT {gs} unnest(range(k)) AS bin, lo, hi, k FROM s {gx})
    SELECT {o} sp.bin, round(lo + (hi - lo) / k * sp.bin, 6) AS low, round(lo + (hi - lo) / k * (sp.bin + 1), 6) AS high, coalesce(cnt, 0) AS cnt {x}
    FROM sp LEFT JOIN b ON b.bin = sp.bin {j}
"""


def _hist_sql(c: str, t: str, k: str, by: str | None = None, log: bool = False) -> str:
    return _HIST.format(
        c=c, t=t, k=k, g=f"{by}," if by else "", gs=f"g.{by}," if by else "", gx=f", (SELECT DISTINCT {by} FROM {t}) g" if by else "",
        o=f"sp.{by}," if by else "", x=", round(CASE WHEN cnt > 0 THEN log10(cnt) END, 8) AS log_cnt" if log else "", j=f"AND b.{by} = sp.{by}" if by else "")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("low", F.round("low", 6)).withColumn("high", F.round("high", 6))


@job("ds01_histogram_30_log", _hist_sql("o_totalprice", "orders", "30", log=True))
def histogram_log(t: Tables) -> DataFrame:
    return _rounded(distributions.histogram(t.orders, "o_totalprice", 30, log_count=True)).withColumn("log_cnt", F.round("log_cnt", 8))


@job("ds01_histogram_100", _hist_sql("value", "events", "100"))
def histogram_100(t: Tables) -> DataFrame:
    return _rounded(distributions.histogram(t.events, "value", 100))


@job("ds02_histogram_unique_bins", _hist_sql("l_quantity", "lineitem", "count(DISTINCT l_quantity) + 2"))
def histogram_unique(t: Tables) -> DataFrame:
    return _rounded(distributions.histogram(t.lineitem, "l_quantity", None))


@job("ds03_histogram_by_group", _hist_sql("p_retailprice", "part", "10", by="p_type"))
def histogram_by_group(t: Tables) -> DataFrame:
    return _rounded(distributions.histogram(t.part, "p_retailprice", 10, by=["p_type"]))


@job("ds04_box_numbers_by_group", """
    WITH q AS (SELECT event_type AS e, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
    SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
           max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
           count(*) FILTER (WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM events JOIN q ON e = event_type GROUP BY event_type, q1, median, q3
""")
def box_numbers(t: Tables) -> DataFrame:
    got = distributions.box_stats(t.events, "value", by=["event_type"])
    return got.select("event_type", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "whisker_low", "whisker_high", "outliers")


@job("ds05_counts_with_hue", "SELECT o_orderpriority, o_orderstatus, count(*) AS cnt FROM orders GROUP BY ALL")
def counts_with_hue(t: Tables) -> DataFrame:
    return distributions.count_by(t.orders, "o_orderpriority", "o_orderstatus")


@job("ds06_density_on_grid", """
    WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
    g AS (SELECT unnest(range(50)) AS point FROM s)
    SELECT point, round(any_value(lo + (hi - lo) * point / 49), 6) AS x,
           round(sum(exp(-0.5 * pow((lo + (hi - lo) * point / 49 - v) / 2.0, 2)) / (2.0 * sqrt(2 * pi())) * c) / sum(c), 8) AS density
    FROM g, s, (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY 1) GROUP BY point
""")
def density(t: Tables) -> DataFrame:
    got = distributions.density_grid(t.lineitem, "l_quantity", 50, 2.0)
    return got.select("point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@job("ds07_bins_of_two_columns", """
    WITH s AS (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl, max(l_extendedprice) AS yh FROM lineitem)
    SELECT least(CAST(floor((l_quantity - xl) / (xh - xl) * 10) AS BIGINT), 9) AS x_bin, least(CAST(floor((l_extendedprice - yl) / (yh - yl) * 20) AS BIGINT), 19) AS y_bin, count(*) AS cnt
    FROM lineitem, s GROUP BY ALL
""")
def bins_of_two(t: Tables) -> DataFrame:
    return distributions.bins_2d(t.lineitem, "l_quantity", "l_extendedprice", 10, 20)


@job("ds07_scatter_sample", """
    SELECT l_quantity, l_extendedprice FROM lineitem
    WHERE floor((((l_orderkey * 31 + l_linenumber) % 1000003) * 7919 + 104729) % 1000003 * 100 / 1000003) < 5
""")
def scatter_sample(t: Tables) -> DataFrame:
    """A twentieth of the rows by their key, whatever the file layout."""
    share = features.key_share(F.col("l_orderkey") * 31 + F.col("l_linenumber"), 100)
    return t.lineitem.filter(share < 5).select("l_quantity", "l_extendedprice")


@job("ds08_mean_by_x", "SELECT l_quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price FROM lineitem GROUP BY 1")
def mean_by_x(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_quantity").agg(exact_mean("l_extendedprice").alias("mean_price"))


@job("ds09_pair_plot_input", " UNION ALL ".join(f"""
    SELECT '{a}' AS a, '{b}' AS b, x_bin, y_bin, count(*) AS cnt, any_value(r) AS r FROM (
        SELECT least(CAST(floor(({a} - xl) / (xh - xl) * 5) AS BIGINT), 4) AS x_bin, least(CAST(floor(({b} - yl) / (yh - yl) * 5) AS BIGINT), 4) AS y_bin, r
        FROM lineitem, (SELECT min({a}) AS xl, max({a}) AS xh, min({b}) AS yl, max({b}) AS yh, round(corr({a}, {b}), 6) AS r FROM lineitem)) GROUP BY x_bin, y_bin"""
    for a, b in (("l_quantity", "l_discount"), ("l_quantity", "l_tax"), ("l_discount", "l_tax"))))
def pair_plot(t: Tables) -> DataFrame:
    cols = ["l_quantity", "l_discount", "l_tax"]
    r = F.broadcast(stats.corr_matrix(t.lineitem, cols))
    out = None
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            part = distributions.bins_2d(t.lineitem, a, b, 5, 5).select(F.lit(a).alias("a"), F.lit(b).alias("b"), "x_bin", "y_bin", "cnt")
            out = part if out is None else out.unionByName(part)
    return out.join(r, ["a", "b"]).select("a", "b", "x_bin", "y_bin", "cnt", F.round("r", 6).alias("r"))


@job("ds10_series_after_dedup", """
    SELECT year(d) AS y, count(*) AS orders, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM (
        SELECT arg_min(o_orderdate, o_orderkey) AS d, arg_min(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey) GROUP BY 1
""")
def series_after_dedup(t: Tables) -> DataFrame:
    first = sets.keep_first(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], ["o_orderkey"])
    return first.groupBy(F.year("o_orderdate").cast("long").alias("y")).agg(F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("amt"))
