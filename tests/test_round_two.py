"""Answers on awkward inputs: fill order, repeated keys, empty drops, table folders, code pages, staged tables."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidewater import registry, staging
from tidewater.operators import features, listings, maintenance, quality, stats, windows
from tidewater.session import shared_dir
from tidewater.sources import files
from tidewater.streaming import filedrop, hourly


def test_overall_mean_after_the_group_fill(spark):
    rows = spark.createDataFrame([(1, "a", 10.0), (2, "a", None), (3, "a", None), (4, "b", 40.0), (5, None, None)], "id int, k string, v double")
    after = {r["id"]: r["v"] for r in quality.fill_group_mean(rows, "v", ["k"], half_even_int=True, overall_after=True).collect()}
    before = {r["id"]: r["v"] for r in quality.fill_group_mean(rows, "v", ["k"], half_even_int=True).collect()}
    assert after == {1: 10.0, 2: 10.0, 3: 10.0, 4: 40.0, 5: 18.0}  # (10 + 10 + 10 + 40) / 4 = 17.5, half to even
    assert before[5] == 25.0


def test_floor_labels(spark):
    rows = spark.createDataFrame([(1, 1), (1, 5), (5, 5), (2, 5)], "f int, t int")
    assert [r[0] for r in rows.select(features.floor_type(F.col("f"), F.col("t"))).collect()] == ["Первый и последний", "Первый", "Последний", "Другой"]


def test_first_cleaning_variant_keeps_years_and_prices():
    assert "price_per_m2" not in listings.PERCENTILE


def test_upsert_takes_one_of_repeated_new_rows(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, v int")
    new = spark.createDataFrame([(1, "x", 5), (1, "y", 4), (3, "z", 9), (3, "z", 9)], "k int, s string, v int")
    got = sorted(tuple(r) for r in maintenance.upsert(base, new, "k", ["v"]).collect())
    assert got == [(1, "a", 4), (2, "b", 2), (3, "z", 9)]


def test_intake_before_the_first_file(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    args = (str(tmp_path / "drop"), "id int, name string", str(tmp_path / "target"), str(tmp_path / "state"))
    assert filedrop.ingest_drop(spark, *args).count() == 0
    spark.createDataFrame([(1, "a")], "id int, name string").write.mode("append").csv(args[0], header=True)
    assert [tuple(r) for r in filedrop.ingest_drop(spark, *args).collect()] == [(1, "a")]


def test_hourly_stream_without_rows(spark, tmp_path):
    events = "ts timestamp, event_type string"
    spark.createDataFrame([], events).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events).parquet(str(tmp_path / "events"))
    hours = hourly.run_to_folder(hourly.hourly_counts(stream, "ts", F.col("event_type") == "error"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert hours.count() == 0


@pytest.mark.parametrize("name", ["ss01_hourly_stream_with_running_totals", "hx02_links", "q10_percent_of_first_line"])
def test_tables_that_are_folders(spark, tmp_path, name):
    from tests.check_oracle import TABLES

    for table in TABLES:
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    got = registry.queries()[name](spark, str(tmp_path))
    want = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0


@pytest.mark.parametrize("page", ["cp1251", "cp437", "koi8-r"])
def test_code_pages_leave_the_session_alone(spark, tmp_path, page):
    text = "id,label\n1,Привет мир\n2,\"a,b\"\n" if page != "cp437" else "id,label\n1,Ünïçødé\n2,\"a,b\"\n".replace("ø", "o")
    (tmp_path / "in.csv").write_bytes(text.encode(page))
    before = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    got = files.read_delimited(spark, str(tmp_path / "in.csv"), "id long, label string", encoding=page)
    assert [r["label"] for r in got.orderBy("id").collect()] == [text.split("\n")[1].split(",")[1], "a,b"]
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == before


def test_thresholds_have_one_path(spark):
    rows = spark.createDataFrame([(float(i % 7),) for i in range(1000)] + [(None,)], "v double")
    assert stats.quantile_numbers(rows, "v", {"a": 0.25, "b": 0.5}) == {"a": 1.0, "b": 3.0}
    assert stats.quantile_numbers(rows.limit(0), "v", {"a": 0.5}) == {"a": None}


def test_bounded_groups_take_one_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 9).alias("k"), "id")
    one, two = (windows.with_group_value(rows, ["k"], bounded=b, m=F.max("id")) for b in (True, False))
    assert one.exceptAll(two).count() == 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_shares_are_even(spark):
    shares = spark.range(100_000).groupBy(features.key_share(F.col("id"), 10).alias("s")).count().collect()
    assert len(shares) == 10 and all(9_000 < r["count"] < 11_000 for r in shares)


def test_staged_tables_can_be_removed(spark):
    staging.stage(spark.range(5)).count()
    folder = f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.exists(path)
    staging.discard(spark)
    assert not fs.exists(path)


@pytest.mark.parametrize("rho", [0.1, 0.4, 0.8])
def test_phi_k_of_a_halved_binormal(rho):
    """Quadrants of a binormal hold 1/4 + asin(rho) / 2 pi, so the table's chi-square is known in closed form."""
    n = 1e9
    same = 0.25 + math.asin(rho) / (2 * math.pi)
    chi2 = n * 4 * 2 * ((same - 0.25) ** 2 + (0.25 - same) ** 2)
    assert stats.phi_k(chi2, [n / 2, n / 2], [n / 2, n / 2]) == pytest.approx(rho, abs=1e-3)


def test_phi_k_ends(spark):
    rows = spark.range(4000).select((F.col("id") % 4).alias("a"), (F.col("id") % 4 + 10).alias("b"), F.floor(F.col("id") / 1000).alias("c"), F.lit(1).alias("d"))
    got = {(r["a"], r["b"]): r["phi_k"] for r in stats.phi_k_matrix(rows, ["a", "b", "c", "d"]).collect()}
    assert got[("a", "b")] == 1.0 and got[("a", "c")] == 0.0 and got[("a", "d")] == 0.0
