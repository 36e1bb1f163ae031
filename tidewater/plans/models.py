"""Feature, statistics, model, matrix and signal queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.arrays import total
from tidewater.functions.numbers import exact_mean
from tidewater.functions.text import map_codes
from tidewater.operators import features, matrix, models, signal, stats
from tidewater.plans.flats import SQL, flats
from tidewater.registry import job
from tidewater.tables import Tables

WITH = f"WITH {SQL} "


@job("ml01_half_open_bins", "SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL WHEN p_size < 20 THEN 'low' WHEN p_size < 40 THEN 'mid' ELSE 'high' END AS bin FROM part")
def half_open_bins(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", features.cut(F.col("p_size").cast("double"), [5.0, 20.0, 40.0, float("inf")], ["low", "mid", "high"]).alias("bin"))


@job("ml02_price_per_unit", WITH + "SELECT line_key, round_even(last_price / nullif(total_area, 0) * 100, 0) / 100 AS price_per_m2 FROM flats")
def price_per_unit(t: Tables) -> DataFrame:
    return flats(t, "line_key", "last_price", "total_area").select(
        "line_key", features.price_per_unit(F.col("last_price"), F.col("total_area")).alias("price_per_m2"))


@job("ml03_floor_type", WITH + """
    SELECT line_key, CASE WHEN floor = 1 AND floors_total = 1 THEN 'Первый и последний' WHEN floor = 1 THEN 'Первый' WHEN floor = floors_total THEN 'Последний' ELSE 'Другой' END AS floor_type FROM flats
""")
def floor_type(t: Tables) -> DataFrame:
    return flats(t, "line_key", "floor", "floors_total").select("line_key", features.floor_type(F.col("floor"), F.col("floors_total")).alias("floor_type"))


@job("ml04_fair_value", WITH + """
    , g AS (SELECT locality_name AS l, rooms AS r, balcony AS b, round_even(CAST(sum(CAST(last_price AS DECIMAL(28,6))) AS DOUBLE) / count(*) * 100, 0) / 100 AS m FROM flats GROUP BY ALL)
    SELECT line_key, m AS fair_price FROM flats LEFT JOIN g ON l = locality_name AND r = rooms AND b = balcony
""")
def fair_value(t: Tables) -> DataFrame:
    df = flats(t, "line_key", "last_price", "locality_name", "rooms", "balcony")
    return features.fair_value(df, "last_price", ["locality_name", "rooms", "balcony"], "fair_price").select("line_key", "fair_price")


@job("ml05_real_and_fair_by_year", WITH + """
    , g AS (SELECT locality_name AS l, rooms AS r, round_even(CAST(sum(CAST(last_price AS DECIMAL(28,6))) AS DOUBLE) / count(*) * 100, 0) / 100 AS m FROM flats GROUP BY ALL)
    SELECT year(first_day) AS y, round(avg(last_price), 3) AS real_price, round(avg(m), 3) AS fair_price FROM flats LEFT JOIN g ON l = locality_name AND r = rooms GROUP BY 1
""")
def real_and_fair(t: Tables) -> DataFrame:
    df = features.fair_value(flats(t, "first_day", "last_price", "locality_name", "rooms"), "last_price", ["locality_name", "rooms"], "fair")
    return df.groupBy(F.year("first_day").cast("long").alias("y")).agg(
        F.round(F.avg("last_price"), 3).alias("real_price"), F.round(F.avg("fair"), 3).alias("fair_price"))


@job("ml06_rate_by_feature", "SELECT l_linenumber + 1 AS family, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END), 8) AS rate, count(*) AS cnt FROM lineitem GROUP BY 1")
def rate_by_feature(t: Tables) -> DataFrame:
    return t.lineitem.groupBy((F.col("l_linenumber") + 1).alias("family")).agg(
        F.round(F.avg((F.col("l_returnflag") == "R").cast("double")), 8).alias("rate"), F.count(F.lit(1)).alias("cnt"))


@job("ml07_label_codes_sorted", "SELECT p_name AS value, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part)")
def label_codes(t: Tables) -> DataFrame:
    return features.label_index(t.part, "p_name")


@job("ml07_label_codes_first_seen", """
    SELECT c_custkey, code FROM customer JOIN (SELECT c_mktsegment AS s, row_number() OVER (ORDER BY min(c_custkey)) - 1 AS code FROM customer GROUP BY 1) ON s = c_mktsegment
""")
def label_codes_first_seen(t: Tables) -> DataFrame:
    return features.label_encode(t.customer, "c_mktsegment", order_by="c_custkey").select("c_custkey", "code")


@job("ml08_one_hot", "SELECT o_orderkey, o_orderstatus = 'F' AS o_orderstatus_F, o_orderstatus = 'O' AS o_orderstatus_O, o_orderstatus = 'P' AS o_orderstatus_P FROM orders")
def one_hot(t: Tables) -> DataFrame:
    return features.one_hot(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["P", "F", "O"]).drop("o_orderstatus")


@job("ml09_binary_map", "SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 ELSE -1 END AS open FROM lineitem")
def binary_map(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", map_codes(F.col("l_linestatus"), {"O": 1, "F": 0}).alias("open"))


@job("ml10_standardise", """
    SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS z, (o_orderkey * 0 + 1 - 1) * 1.0::DOUBLE AS constant FROM orders
""")
def standardise(t: Tables) -> DataFrame:
    src = t.orders.select("o_orderkey", F.col("o_totalprice").alias("z"), (F.col("o_orderkey") * 0 + 1).alias("constant"))
    return features.standardise(src, ["z", "constant"]).select("o_orderkey", F.round("z", 6).alias("z"), "constant")


_CORR = ("l_quantity", "l_extendedprice", "l_discount")


@job("ml11_correlation_matrix", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in _CORR for b in _CORR))
def correlation_matrix(t: Tables) -> DataFrame:
    return stats.corr_matrix(t.lineitem, list(_CORR)).select("a", "b", F.round("r", 6).alias("r"))


@job("ml12_linear_trend", "SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem")
def linear_trend(t: Tables) -> DataFrame:
    return stats.linear_trend(t.lineitem, "l_quantity", "l_extendedprice").select(F.round("slope", 5).alias("slope"), F.round("intercept", 3).alias("intercept"))


def _assoc_sql() -> str:
    cols = {"l_linenumber": "l_linenumber", "l_returnflag": "l_returnflag",
            "l_quantity": "least(floor((l_quantity - qlo) / (qhi - qlo) * 5), 4)"}
    names = ["l_returnflag", "l_linenumber", "l_quantity"]
    parts = []
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            parts.append(f"""
            SELECT '{a}' AS a, '{b}' AS b, round(any_value(n) * (sum(o * o / (rx * cy)) - 1), 6) AS chi2,
                   round(sqrt(greatest(sum(o * o / (rx * cy)) - 1, 0) / (least(count(DISTINCT x), count(DISTINCT y)) - 1)), 6) AS cramers_v
            FROM (SELECT x, y, CAST(count(*) AS DOUBLE) AS o, CAST(sum(count(*)) OVER (PARTITION BY x) AS DOUBLE) AS rx, CAST(sum(count(*)) OVER (PARTITION BY y) AS DOUBLE) AS cy,
                         CAST(sum(count(*)) OVER () AS DOUBLE) AS n
                  FROM (SELECT {cols[a]} AS x, {cols[b]} AS y FROM lineitem, (SELECT min(l_quantity) AS qlo, max(l_quantity) AS qhi FROM lineitem)) GROUP BY x, y)""")
    return " UNION ALL ".join(parts)


@job("ml13_association_matrix", _assoc_sql())
def association_matrix(t: Tables) -> DataFrame:
    got = stats.association_matrix(t.lineitem, ["l_returnflag", "l_linenumber", "l_quantity"], ["l_quantity"], bins=5)
    return got.select("a", "b", F.round("chi2", 6).alias("chi2"), F.round("cramers_v", 6).alias("cramers_v"))


@job("ml13_phi_k")
def phi_k(t: Tables) -> DataFrame:
    return stats.phi_k_matrix(t.lineitem, ["l_returnflag", "l_linenumber", "l_quantity", "l_discount"], ["l_quantity", "l_discount"], bins=5)


@job("ml14_split_by_key", "SELECT CAST(o_orderkey % 5 = 0 AS BOOLEAN) AS validation, count(*) AS cnt FROM orders GROUP BY 1")
def split_by_key(t: Tables) -> DataFrame:
    side = F.col("o_orderkey") % 5 == 0
    return t.orders.groupBy(side.alias("validation")).agg(F.count(F.lit(1)).alias("cnt"))


@job("ml14_hash_split", """
    SELECT CASE WHEN floor(((o_orderkey % 1000003) * 7919 + 104729) % 1000003 * 100 / 1000003) < 80 THEN 'train' ELSE 'validation' END AS side, count(*) AS cnt
    FROM orders GROUP BY 1
""")
def hash_split(t: Tables) -> DataFrame:
    train, valid = features.hash_split(t.orders, "o_orderkey", 80)
    return train.agg(F.lit("train").alias("side"), F.count(F.lit(1)).alias("cnt")).unionByName(
        valid.agg(F.lit("validation").alias("side"), F.count(F.lit(1)).alias("cnt")))


_NEAR = """
    WITH tr AS (SELECT * FROM embeddings WHERE vec_id % 5 <> 0), q AS (SELECT * FROM embeddings WHERE vec_id % 5 = 0),
    d AS (SELECT q.vec_id, q.label AS truth, tr.vec_id AS nb, tr.label AS y, {distance} AS dist FROM q, tr),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nb) AS rn FROM d) WHERE rn <= {k}),
    v AS (SELECT vec_id, any_value(truth) AS truth, y, count(*) AS n FROM k GROUP BY vec_id, y),
    p AS (SELECT vec_id, any_value(truth) AS truth, arg_min(y, (-n, y)) AS predicted FROM v GROUP BY vec_id)
"""
_EUCLID = "sqrt(list_sum(list_transform(list_zip(q.embedding, tr.embedding), lambda z: pow(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE), 2))))"
_MANHATTAN = "list_sum(list_transform(list_zip(q.embedding, tr.embedding), lambda z: abs(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE))))"


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.embeddings.filter("vec_id % 5 <> 0"), t.embeddings.filter("vec_id % 5 = 0")


def _classified(t: Tables) -> DataFrame:
    train, queries = _halves(t)
    predicted = models.knn(train, queries, "embedding", "label", "vec_id", 15)
    return queries.select("vec_id", F.col("label").alias("truth")).join(predicted, "vec_id")


@job("ml15_knn_classify", _NEAR.format(distance=_EUCLID, k=15) + "SELECT vec_id, truth, predicted FROM p")
def knn_classify(t: Tables) -> DataFrame:
    return _classified(t)


@job("ml16_knn_regress", _NEAR.format(distance=_MANHATTAN, k=3) + "SELECT vec_id, round(avg(y), 6) AS predicted FROM k GROUP BY vec_id")
def knn_regress(t: Tables) -> DataFrame:
    train, queries = _halves(t)
    got = models.knn(train, queries, "embedding", "label", "vec_id", 3, metric="manhattan", mode="regress")
    return got.select("vec_id", F.round("predicted", 6).alias("predicted"))


_CALLS = "(SELECT doc_id, quality AS truth, CASE WHEN doc_id % 3 = 0 THEN 1 - quality ELSE quality END AS predicted FROM labels)"


def _calls(t: Tables) -> DataFrame:
    flipped = F.when(F.col("doc_id") % 3 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    return t.labels.select("doc_id", F.col("quality").alias("truth"), flipped.alias("predicted"))


@job("ml17_accuracy", f"SELECT round(avg(CASE WHEN truth = predicted THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy FROM {_CALLS}")
def accuracy(t: Tables) -> DataFrame:
    return models.accuracy(_calls(t), "truth", "predicted").select(F.round("accuracy", 8).alias("accuracy"))


@job("ml17_confusion_matrix", f"SELECT truth, predicted, count(*) AS cnt FROM {_CALLS} GROUP BY ALL")
def confusion(t: Tables) -> DataFrame:
    return models.confusion(_calls(t), "truth", "predicted")


@job("ml17_class_report", f"""
    WITH c AS (SELECT l.label, count(*) FILTER (WHERE truth = l.label) AS support, count(*) FILTER (WHERE predicted = l.label) AS called,
                      count(*) FILTER (WHERE truth = l.label AND predicted = l.label) AS hit FROM {_CALLS}, (VALUES (0), (1)) l(label) GROUP BY 1),
    r AS (SELECT label, support, coalesce(hit / CAST(nullif(called, 0) AS DOUBLE), 0) AS p, coalesce(hit / CAST(nullif(support, 0) AS DOUBLE), 0) AS rc FROM c)
    SELECT label, round(p, 8) AS precision, round(rc, 8) AS recall, round(coalesce(2 * p * rc / nullif(p + rc, 0), 0), 8) AS f_score, support FROM r
""")
def class_report(t: Tables) -> DataFrame:
    got = models.class_report(_calls(t), "truth", "predicted")
    return got.select("label", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f_score")], "support")


@job("ml18_regression_errors", """
    SELECT round(avg(pow(e, 2)), 4) AS mse, round(avg(abs(e)), 6) AS mae, round(max(abs(e)), 6) AS max_error
    FROM (SELECT l_extendedprice / 1000 - l_quantity AS e FROM lineitem)
""")
def regression_errors(t: Tables) -> DataFrame:
    src = t.lineitem.select((F.col("l_extendedprice") / 1000).alias("y"), F.col("l_quantity").alias("p"))
    return models.regression_errors(src, "y", "p").select(F.round("mse", 4).alias("mse"), F.round("mae", 6).alias("mae"), F.round("max_error", 6).alias("max_error"))


@job("ml19_prediction_differences", f"SELECT count(*) AS different FROM {_CALLS} WHERE truth <> predicted")
def differences(t: Tables) -> DataFrame:
    calls = _calls(t)
    return models.count_differences(calls.select("doc_id", F.col("truth").alias("y")), calls.select("doc_id", F.col("predicted").alias("y")), "doc_id", "y")


@job("ml20_chunk_signal", """
    SELECT (rn - 1) // 1000 AS chunk_id, CAST(1000 AS BIGINT) AS width, round(sum(value), 4) AS total, round(arg_min(value, rn), 4) AS first_sample
    FROM (SELECT value, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events) GROUP BY 1
""")
def chunk_signal(t: Tables) -> DataFrame:
    c = signal.chunk(t.events, ["ts", "event_id"], "value", 1000)
    return c.select("chunk_id", F.size("samples").cast("long").alias("width"), F.round(total(F.col("samples")), 4).alias("total"),
                    F.round(F.get("samples", F.lit(0)), 4).alias("first_sample"))


@job("ml21_chunk_round_trip", "SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, value AS v FROM events")
def round_trip(t: Tables) -> DataFrame:
    c = signal.chunk(t.events, ["ts", "event_id"], "value", 768)
    return signal.unchunk(c, 768, t.events.count())


@job("ml22_pca_scores")
def pca_scores(t: Tables) -> DataFrame:
    fit = signal.pca_fit(t.embeddings, "embedding", 8)
    return signal.pca_transform(t.embeddings, "embedding", fit).select("vec_id", "scores")


@job("ml23_pca_restored")
def pca_restored(t: Tables) -> DataFrame:
    fit = signal.pca_fit(t.embeddings, "embedding", 8)
    scored = signal.pca_transform(t.embeddings, "embedding", fit)
    return signal.pca_inverse(scored, "scores", fit).select("vec_id", "restored")


@job("ml23_pca_full_width_restores_rows", """
    SELECT vec_id, true AS same FROM embeddings
""")
def pca_full_width(t: Tables) -> DataFrame:
    fit = signal.pca_fit(t.embeddings, "embedding", 64)
    back = signal.pca_inverse(signal.pca_transform(t.embeddings, "embedding", fit), "scores", fit)
    close = F.forall(F.zip_with("embedding", "restored", lambda a, b: F.abs(a - b) < 1e-6), lambda x: x)
    return back.select("vec_id", close.alias("same"))


@job("ml24_pca_curve")
def pca_curve(t: Tables) -> DataFrame:
    fit = signal.pca_fit(t.embeddings, "embedding", 32)
    return signal.pca_curve(t.embeddings, "embedding", fit, [1, 2, 4, 8, 16, 32]).withColumn("chosen_k", F.lit(signal.choose_k(fit)))


@job("ml25_channels_to_mono", "SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity + l_extendedprice) / 2, 6) AS mono FROM lineitem")
def to_mono(t: Tables) -> DataFrame:
    src = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return signal.to_mono(src, ["l_quantity", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", F.round("mono", 6).alias("mono"))


def _scaled_lines(t: Tables) -> DataFrame:
    return t.lineitem.select((F.col("l_quantity") / 50).alias("qty"), (F.col("l_discount") * 10).alias("disc"), (F.col("l_extendedprice") / 100000).alias("price"))


@job("ml26_gradient_descent_path")
def gradient_descent(t: Tables) -> DataFrame:
    return models.fit_gd(_scaled_lines(t), ["qty", "disc"], "price")


@job("ml27_rmsprop_path")
def rmsprop(t: Tables) -> DataFrame:
    return models.fit_rmsprop(_scaled_lines(t), ["qty", "disc"], "price")


def _long(t: Tables) -> DataFrame:
    """Suppliers x parts: quantities sold, as (i, j, v)."""
    return t.lineitem.groupBy(F.col("l_suppkey").alias("i"), F.col("l_linenumber").cast("long").alias("j")).agg(F.sum("l_quantity").alias("v"))


_LONG = "WITH a AS (SELECT l_suppkey AS i, CAST(l_linenumber AS BIGINT) AS j, sum(l_quantity) AS v FROM lineitem GROUP BY ALL) "


@job("ml28_matrix_product", _LONG + "SELECT x.i, y.i AS j, sum(x.v * y.v) AS v FROM a x JOIN a y ON x.j = y.j GROUP BY ALL")
def matrix_product(t: Tables) -> DataFrame:
    a = _long(t)
    return matrix.matmul(a, matrix.transpose(a))


@job("ml28_gram_matrix", _LONG + "SELECT x.j AS i, y.j AS j, sum(x.v * y.v) AS v FROM a x JOIN a y ON x.i = y.i GROUP BY ALL")
def gram_matrix(t: Tables) -> DataFrame:
    """A'A of a tall matrix: the inner index grows with the table, the result doesn't."""
    a = _long(t)
    return matrix.matmul(matrix.transpose(a), a)


def _dense_long(t: Tables) -> DataFrame:
    """Vectors x dimensions, every cell filled, as (i, j, v)."""
    return t.embeddings.select(F.col("vec_id").cast("long").alias("i"), F.posexplode("embedding").alias("j", "v")).select(
        "i", F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v"))


@job("ml28_dense_product", """
    WITH e AS (SELECT vec_id AS i, unnest(range(len(embedding))) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
    g AS (SELECT x.j AS i, y.j AS j, sum(x.v * y.v) AS v FROM e x JOIN e y ON x.i = y.i GROUP BY ALL)
    SELECT CAST(e.i AS BIGINT) AS i, CAST(g.j AS BIGINT) AS j, round(sum(e.v * g.v), 4) AS v FROM e JOIN g ON e.j = g.i GROUP BY ALL
""")
def dense_product(t: Tables) -> DataFrame:
    """E (E'E): two dense products, in blocks."""
    e = _dense_long(t)
    return matrix.matmul(e, matrix.matmul(matrix.transpose(e), e)).withColumn("v", F.round("v", 4))


@job("ml29_transpose", _LONG + "SELECT j AS i, i AS j, v FROM a")
def transpose(t: Tables) -> DataFrame:
    return matrix.transpose(_long(t))


@job("ml29_symmetrise", _LONG + "SELECT i, j, v FROM a WHERE i >= j UNION ALL SELECT j, i, v FROM a WHERE i > j")
def symmetrise(t: Tables) -> DataFrame:
    return matrix.symmetrise(_long(t).filter("i >= j"))


@job("ml29_diagonal_product", _LONG + "SELECT round(log10(product(v)), 6) AS log_product FROM a WHERE i = j AND v > 0")
def diagonal_product(t: Tables) -> DataFrame:
    return matrix.diag_product(_long(t)).select(F.round(F.log10("product"), 6).alias("log_product"))


@job("ml30_one_entity_against_all", """
    WITH p AS (SELECT p_partkey, p_retailprice, percent_rank() OVER (ORDER BY p_retailprice) AS pr FROM part)
    SELECT p_partkey, p_retailprice, round((SELECT avg(p_retailprice) FROM part), 6) AS mean_price, round(pr, 8) AS percentile FROM p WHERE p_partkey = 42
""")
def one_entity(t: Tables, key: int = 42) -> DataFrame:
    one = t.part.filter(F.col("p_partkey") == key)
    own = one.agg(F.max("p_retailprice")).scalar()
    # The percent rank of one value needs two counts, not a ranking of all rows.
    s = t.part.agg(F.struct(F.avg("p_retailprice").alias("m"), F.count_if(F.col("p_retailprice") < own).alias("below"), F.count("p_retailprice").alias("n"))).scalar()
    return one.withColumn("_s", s).select("p_partkey", "p_retailprice", F.round(F.col("_s.m"), 6).alias("mean_price"),
                                          F.round(F.coalesce(F.try_divide(F.col("_s.below"), F.col("_s.n") - 1), F.lit(0.0)), 8).alias("percentile"))


@job("ml31_yearly_comparison", """
    WITH y AS (SELECT year(o_orderdate) AS y, count(DISTINCT o_custkey) AS customers, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price FROM orders GROUP BY 1),
    m AS (SELECT y, arg_min(o_orderpriority, (-n, o_orderpriority)) AS top_priority FROM (SELECT year(o_orderdate) AS y, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) GROUP BY y)
    SELECT y, customers, round(mean_price, 4) AS mean_price, round(mean_price - lag(mean_price) OVER (ORDER BY y), 4) AS change, top_priority FROM y JOIN m USING (y)
""")
def yearly_comparison(t: Tables) -> DataFrame:
    year = F.year("o_orderdate").cast("long").alias("y")
    per_year = t.orders.groupBy(year).agg(F.count_distinct("o_custkey").alias("customers"), exact_mean("o_totalprice").alias("mean_price"))
    counts = t.orders.groupBy(year, "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("y").agg(F.min_by("o_orderpriority", F.struct((-F.col("n")).alias("n"), "o_orderpriority")).alias("top_priority"))
    w = Window.orderBy("y")  # one row per year
    change = F.col("mean_price") - F.lag("mean_price").over(w)
    return per_year.join(top, "y").select("y", "customers", F.round("mean_price", 4).alias("mean_price"), F.round(change, 4).alias("change"), "top_priority")
