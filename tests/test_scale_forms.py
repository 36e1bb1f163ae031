"""The distributed forms give what the plain one-task forms give, on skewed input too."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater import registry
from tidewater.operators import ordering, patterns, ranges, selection, stats, windows
from tidewater.operators.windows import Scan, scan_along
from tidewater.staging import frames_along


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share one key and one value."""
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        hot = rng.random() < 0.5
        value = 7 if hot else rng.randint(0, 50)
        rows.append((i, "hot" if hot else rng.choice(["a", "b", None]), value, None if rng.random() < 0.4 else value))
    return spark.createDataFrame(rows, "id long, k string, v int, gap int").cache()


def test_counted_quantiles_equal_sketched_ones(skewed):
    qs = {"a": 0.25, "b": 0.5, "c": 0.99}
    for col in ("v", "gap", "id"):
        for by in ([], ["k"]):
            want = {tuple(r) for r in selection.exact_quantiles(skewed, col, qs, by=by).collect()}
            for most in (20_000, 40):
                assert {tuple(r) for r in selection.exact_quantiles(skewed, col, qs, by=by, most=most, counted=True).collect()} == want
    assert list(selection.exact_quantiles(skewed.limit(0), "v", qs, counted=True).first()) == [None] * 3
    assert selection.few_valued(skewed, ["v", "id"], most=200) == {"v"}


def test_cleaning_sketches_only_columns_of_many_values(spark, monkeypatch):
    seen, sketch = [], selection._first_cells
    monkeypatch.setattr(selection, "_first_cells", lambda *a: seen.append(1) or sketch(*a))
    registry.queries()["q31_cleaning_by_iqr"](spark, "/root/testdata/sf0.001")
    assert len(seen) <= 4  # 13 thresholds; prices, ratios and filled areas may have many values


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_scans_equal_windows(skewed, keys):
    order = [F.col("v").desc(), F.col("id").asc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    got = scan_along(skewed, order, {
        "s": Scan("sum", F.col("v").cast("long")), "hi": Scan("max", F.col("id")), "lo": Scan("min", F.col("id")),
        "f": Scan("last", F.col("gap")), "p": Scan("lag", F.col("gap"))}, keys, partitions=7)
    want = skewed.select("*", F.sum("v").over(upto).alias("s"), F.max("id").over(upto).alias("hi"), F.min("id").over(upto).alias("lo"),
                         F.last("gap", True).over(upto).alias("f"), F.lag("gap").over(w).alias("p"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("partitions", [3, 60, 1000])
def test_sliding_frames_equal_windows(skewed, keys, partitions):
    """Halos from as many slices as it takes: in the last case most slices are shorter than the frame."""
    order = [F.col("v").desc(), F.col("id").asc()]
    small = skewed if partitions < 1000 else skewed.filter("id % 40 = 0")
    frames = {
        "mean": lambda w: F.avg("v").over(w.rowsBetween(-6, 0)), "n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-6, 3)),
        "gone": lambda w: F.lag("gap", 5, -1).over(w), "next": lambda w: F.lead("id", 3).over(w), "list": lambda w: F.collect_list("id").over(w.rowsBetween(-2, 2))}
    got = frames_along(small, order, frames, 6, 3, keys, partitions=partitions if partitions < 1000 else 90)
    w = Window.partitionBy(*keys).orderBy(*order)
    want = small.select("*", *[f(w).alias(o) for o, f in frames.items()])
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_sliding_frames_have_no_one_task_window(skewed):
    got = frames_along(skewed, [F.col("id")], {"m": lambda w: F.avg("v").over(w.rowsBetween(-4, 0))}, 4)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert frames_along(skewed.limit(0), [F.col("id")], {"m": lambda w: F.avg("v").over(w.rowsBetween(-4, 0))}, 4).count() == 0


def test_row_number_is_dense(skewed):
    got = windows.global_row_number(skewed, [F.col("v"), F.col("id")], "rn", partitions=9).toPandas()
    want = skewed.toPandas().sort_values(["v", "id"])["id"].tolist()
    assert got.sort_values("rn")["id"].tolist() == want
    assert sorted(got["rn"]) == list(range(1, len(want) + 1))


@pytest.mark.parametrize("seed", range(6))
def test_quantiles_equal_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    n = [1, 2, 7, 500, 3000, 20000][seed]
    values = np.where(rng.random(n) < 0.35, 3.25, np.round(rng.normal(10, 40, n), 3))
    pdf = pd.DataFrame({"g": rng.choice(["x", "y", "z"], n, p=[0.8, 0.15, 0.05]), "v": values})
    df = spark.createDataFrame(pdf)
    qs = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.75, "f": 0.99, "g9": 1.0}
    for accuracy in (100_000, 200):
        row = stats.exact_quantiles(df, "v", qs, accuracy=accuracy).first()
        assert [row[k] for k in qs] == pytest.approx(list(pdf["v"].quantile(list(qs.values()))))
        grouped = stats.exact_quantiles(df, "v", qs, by=["g"], accuracy=accuracy).toPandas().set_index("g")
        for g, part in pdf.groupby("g"):
            assert list(grouped.loc[g]) == pytest.approx(list(part["v"].quantile(list(qs.values()))))


@pytest.mark.parametrize("limits", [{}, {"accuracy": 100, "most": 400}, {"accuracy": 50, "most": 40, "fan": 24}, {"accuracy": 2000, "most": 12, "fan": 8}])
def test_quantiles_do_not_depend_on_rounds(spark, limits, monkeypatch):
    """One round or many: the same order statistics, for a hot value, a null key, small groups and an empty table."""
    rounds = []
    narrowed = selection._narrowed
    monkeypatch.setattr(selection, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    rng = np.random.default_rng(8)
    n = 12_000
    pdf = pd.DataFrame({"g": rng.choice(["x", "y", None], n, p=[0.9, 0.09, 0.01]), "v": np.where(rng.random(n) < 0.35, 3.25, rng.normal(10, 40, n).round(5))})
    df = spark.createDataFrame(pdf)
    qs = {"low": 0.013, "mid": 0.5} if limits.get("fan") != 8 else {"mid": 0.5}
    got = selection.exact_quantiles(df, "v", qs, **limits).first()
    assert list(got) == pytest.approx(list(pdf["v"].quantile(list(qs.values()))), abs=0, rel=1e-15)
    grouped = {r["g"]: [r[q] for q in qs] for r in selection.exact_quantiles(df, "v", qs, by=["g"], **limits).collect()}
    for g in ("x", "y", None):
        part = pdf["v"][pdf["g"].isna() if g is None else pdf["g"] == g]
        assert grouped[g] == pytest.approx(list(part.quantile(list(qs.values()))), abs=0, rel=1e-15)
    assert (len(rounds) >= 2) if limits.get("most", 400) < 400 else (len(rounds) <= 4)
    assert list(selection.exact_quantiles(df.limit(0), "v", qs).first()) == [None] * len(qs)
    assert selection.exact_quantiles(df.limit(0), "v", qs, by=["g"]).count() == 0


@pytest.mark.parametrize("own", [True, False])
def test_interval_counts_equal_theta_join(spark, own):
    rng = random.Random(3)
    rows, asked = [], []
    for _ in range(400):
        a = rng.randint(0, 60)
        rows.append((a, a + rng.choice([0, 0, 1, 5, 40, -2 if own else 7])))
        asked.append((rng.randint(-5, 80), rng.randint(-5, 110)))
    rows += [(None, 3), (4, None)]
    df, probes = spark.createDataFrame(rows, "a int, b int"), spark.createDataFrame([*asked, (None, 3)], "a int, b int")
    got = [tuple(r) for r in ranges.interval_counts(df, "a", "b", None if own else probes).collect()]
    whole = [(a, b) for a, b in rows if a is not None and b is not None and a <= b]
    want = set()
    for s, e in {r for r in rows if None not in r} if own else set(asked):
        air = sum(1 for a, b in whole if a <= e < b)
        done = sum(1 for a, b in whole if s > b)
        if air or done:
            want.add((s, e, air, done))
    assert len(got) == len(set(got)) and set(got) == want


def test_interval_counts_read_their_source_once(spark):
    """What is left after the table of spans reads neither orders nor lineitem."""
    for name in ("jn09_interval_counts", "q27_open_and_finished_counts"):
        got = registry.queries()[name](spark, "/root/testdata/sf0.001")
        assert not {"orders", "lineitem"} & {f.rsplit("/", 1)[-1].split(".")[0] for f in got.inputFiles()}


@pytest.mark.parametrize("signed", [False, True])
def test_nearest_group_equals_brute_force(spark, signed):
    rng = random.Random(9)
    points = [(i, rng.choice([5.0, rng.uniform(-10, 30)])) for i in range(300)]
    centers = [("g%d" % i, rng.choice([4.0, 6.0, rng.uniform(-10, 30)])) for i in range(12)]
    got = ranges.nearest_group(spark.createDataFrame(points, "id long, v double"),
                               spark.createDataFrame(centers, "g string, c double"), "v", "g", "c", "id", signed)
    for r in got.collect():
        key = (lambda g: (-g[1], g[0])) if signed else (lambda g: (abs(r["v"] - g[1]), g[0]))
        best = min(centers, key=(lambda g: (r["v"] - g[1], g[0])) if signed else key)
        assert r["nearest_g"] == best[0]


def test_top_k_with_ties_keeps_all_ties(skewed):
    got = {r["id"] for r in ordering.top_k_with_ties(skewed, "v", 3, desc=False, rank_col="r").collect()}
    pdf = skewed.toPandas()
    edge = sorted(set(pdf["v"]))[2]
    assert got == set(pdf[pdf["v"] <= edge]["id"])


@pytest.mark.parametrize("n,chunk", [(1, 4), (3, 4), (17, 5), (300, 32)])
def test_gaussian_smooth_equals_direct(spark, n, chunk):
    rng = np.random.default_rng(n)
    series = rng.normal(size=n)
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(series)] + [("t", 0, 2.5)], "k string, i int, v double")
    got = windows.gaussian_smooth(df, ["k"], ["i"], "v", 2.0, chunk=chunk).toPandas()
    weights = np.array(windows.gaussian_weights(2.0))
    padded = np.pad(series, 8, mode="symmetric")
    want = np.array([(padded[i:i + 17] * weights).sum() for i in range(n)])
    mine = got[got["k"] == "s"].sort_values("i")["smooth"].to_numpy()
    assert np.allclose(mine, want)
    assert got[got["k"] == "t"]["smooth"].iloc[0] == pytest.approx(2.5)


def test_weighted_average_forms_agree(spark):
    df = spark.createDataFrame([(i, float(i * i % 17)) for i in range(40)], "d int, v double")
    a = windows.weighted_ma(df, ["d"], "v", [5, 4, 3, 2, 1], "lag").toPandas().sort_values("d")["weighted_ma"]
    b = windows.weighted_ma(df, ["d"], "v", [5, 4, 3, 2, 1], "array").toPandas().sort_values("d")["weighted_ma"]
    assert np.allclose(a, b)


def _like(pattern, name):
    """ILIKE in plain Python: % any text, _ one letter, backslash before a letter takes it as it is."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i])
        else:
            out += ".*" if c == "%" else "." if c == "_" else re.escape(c)
        i += 1
    return re.fullmatch(out, name, re.S) is not None


def test_rules_meet_names_through_their_pieces(spark):
    rng = random.Random(12)
    names = ["".join(rng.choice("abcA_ %") for _ in range(rng.randint(0, 9))) for _ in range(300)] + [None, "", "abcabcabc", "a\\b"]
    rules = {("".join(rng.choice("abcB%%_") for _ in range(rng.randint(0, 6))), rng.choice("xyz")) for _ in range(160)}
    rules |= {("", "empty"), ("%", "all"), ("___%", "long"), ("_%__", "long too"), ("abc\\%%", "escaped"), ("%\\_a%", "score"), ("\\_\\%", "both"), (None, "none"), ("%cab%", None)}
    got = patterns.match_rules(spark.createDataFrame([(i, n, "old") for i, n in enumerate(names)], "id int, name string, action string"),
                               spark.createDataFrame(list(rules), "pattern string, action string"))
    assert got.columns == ["id", "name", "action"]
    found = {r["id"]: r["action"] for r in got.collect()}
    assert len(found) == len(names)
    for i, n in enumerate(names):
        fits = [] if n is None else [(p.lower() != n.lower(), -len(p), p, a is None, a or "") for p, a in rules
                                     if p is not None and (p.lower() == n.lower() or _like(p.lower(), n.lower()))]
        best = min(fits, default=None)
        assert (found[i] or "") == (best[4] if best else ""), (n, best)


def test_many_rules_are_neither_collected_nor_paired(spark):
    names = spark.range(4_000).selectExpr("concat('item ', lpad(id, 6, '0'), ' of ', id % 7) AS name")
    rules = spark.range(10_000).selectExpr("concat('%', lpad(id, 6, '0'), '%') AS pattern", "concat('rule ', id) AS action")
    got = patterns.match_rules(names, rules)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert got.filter("action = concat('rule ', cast(substring(name, 6, 6) AS int))").count() == 4_000
