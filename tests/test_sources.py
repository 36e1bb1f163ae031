"""Files, pages, streams and table upkeep on small fixtures."""

from __future__ import annotations

import codecs

import pytest
from pyspark.sql import functions as F

from tidewater.operators import maintenance, patterns, quality
from tidewater.sources import files, html, jdbc
from tidewater.streaming import filedrop, hourly


def test_byte_order_mark_and_decimal_comma(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(codecs.BOM_UTF8 + "id;v\n1;2,5\n2;x\n3;\n4;NaN\n".encode())
    got = files.read_delimited(spark, str(path), "id int, v double", sep=";", decimal=",").orderBy("id").collect()
    assert [(r["id"], r["v"]) for r in got] == [(1, 2.5), (2, None), (3, None), (4, None)]


@pytest.mark.parametrize("page,word", [("cp1251", "Жанр"), ("cp437", "café")])
def test_old_code_pages(spark, tmp_path, page, word):
    path = tmp_path / "b.csv"
    path.write_bytes(f"id,w\n1,{word}\n".encode(page))
    encoding = {"cp1251": "windows-1251", "cp437": "IBM437"}[page]
    assert files.read_delimited(spark, str(path), "id int, w string", encoding=encoding).first()["w"] == word


def test_nan_is_read_as_null(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("v\nNaN\n1.5\n")
    assert [r["v"] for r in files.read_delimited(spark, str(path), "v double").orderBy("v").collect()] == [None, 1.5]


def test_jdbc_cuts_follow_the_key_range():
    got = jdbc.jdbc_options("jdbc:postgresql://host/db", "t", "id", 1, 2_500_000)
    assert got["numPartitions"] == "3" and got["partitionColumn"] == "id" and got["upperBound"] == "2500000"


def test_month_is_replaced_and_others_stay(spark, tmp_path):
    for m, v in (("2024-01", 1), ("2024-02", 2)):
        (tmp_path / f"{m}.csv").write_text(f"v\n{v}\n")
        files.land_month(spark, f"{tmp_path}/{{month}}.csv", m, "v int", f"{tmp_path}/land")
    (tmp_path / "2024-01.csv").write_text("v\n10\n11\n")
    files.land_month(spark, f"{tmp_path}/{{month}}.csv", "2024-01", "v int", f"{tmp_path}/land")
    assert sorted(r["v"] for r in files.load_month(spark, f"{tmp_path}/land", "2024-01").collect()) == [10, 11]
    assert [r["v"] for r in files.load_month(spark, f"{tmp_path}/land", "2024-02").collect()] == [2]


PAGE = """<html><head><title> My &amp; page </title><style>p{}</style></head><body><P>text 12 and 7</P>
<a href="x.html">One <b>bold</b></a><a name=anchor>none</a><A HREF='y.html'>Two</A><img src=a.png><img alt="no source">
<table><tr><th>h</th></tr><tr><td> r1 </td><td>4.5</td></tr></table><table><tr><td>r2<td>9.0</tr></table>
<div class="book big"><div class="author">A</div><a>T1</a></div><div class="book"><a>T2</a><div class="title_data price">5</div></div>
<script>var x = 1 < 2;</script></body></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>no title, no body")], "page_id long, html string")


def test_titles_and_links(pages):
    assert [tuple(r) for r in html.extract_titles(pages).collect()] == [(1, "My & page")]
    got = [tuple(r)[1:] for r in html.extract_links(pages).orderBy("pos").collect()]
    assert got == [(0, "x.html", "One bold"), (2, "y.html", "Two")]
    assert html.extract_links(pages, suffix="y.html").count() == 1
    assert [r["src"] for r in html.extract_images(pages).collect()] == ["a.png"]


def test_rows_pairs_and_body(pages):
    rows = html.extract_rows(pages)
    assert [(r["table_no"], r["row_no"], r["cells"]) for r in rows.orderBy("row_no").collect()] == [(0, 0, ["r1", "4.5"]), (1, 1, ["r2", "9.0"])]
    best = html.top_rated(rows, 0, 1).collect()
    assert [(r["name"], r["number"]) for r in best] == [("r2", 9.0)]
    body = html.extract_body(pages).filter("page_id = 1")
    assert "var x" not in body.first()["body"]
    assert html.first_number(body).first()["number"] == 12


def test_records_keep_their_columns_together(pages):
    got = html.extract_records(pages, "book", {"title": ("a", None), "author": ("div", "author"), "price": ("div", "title_data price")})
    assert [tuple(r)[1:] for r in got.orderBy("card_no").collect()] == [(0, "T1", "A", ""), (1, "T2", "", "5")]


def test_pages_of_one_file_are_parsed_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(html, "PAGES", 50)
    page = "<body>%s<img src='a.png'><img src='b.png'></body>"
    spark.createDataFrame([(7 if i % 2 else i, page % i) for i in range(400)], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages")
    one = spark.read.parquet(f"{tmp_path}/pages")
    for got in (html.extract_images(one), html.extract_images(html.dealt(one))):
        tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) == 8 and max(tasks) <= 2 * 60 and sum(tasks) == 800
    assert got.filter("page_id = 7").count() == 400
    assert "Repartition" not in html.extract_images(one.limit(50))._jdf.queryExecution().optimizedPlan().toString()
    assert html.extract_images(one.limit(0)).count() == 0


def test_upsert_changes_one_column(spark):
    base = spark.createDataFrame([("1", 10, "old"), ("2", 20, "stay")], "code string, rooms int, description string")
    new = spark.createDataFrame([("1", 99, "new"), ("5F", 30, None)], base.schema)
    got = sorted(tuple(r) for r in maintenance.upsert(base, new, "code", ["description"]).collect())
    assert got == [("1", 10, "new"), ("2", 20, "stay"), ("5F", 30, None)]


def test_keys_start_at_one_in_an_empty_table(spark):
    base = spark.createDataFrame([], "id long, n string")
    new = spark.createDataFrame([("b",), ("a",)], "n string")
    got = sorted(tuple(r) for r in maintenance.assign_ids(base, new, "id", [F.col("n")]).select("id", "n").collect())
    assert got == [(1, "a"), (2, "b")]
    assert maintenance.delete_min(base, "id").count() == 0


def test_rule_precedence(spark):
    names = spark.createDataFrame([("dim_scd",), ("x_history",), ("ya_table",), ("yaXtable",), ("plain",)], "name string")
    rules = spark.createDataFrame([("%_SCD", "Copy with data"), ("%_History", "Skip"), ("ya_table", "Skip"), ("%_table", "Copy schema")], "pattern string, action string")
    got = {r["name"]: r["action"] for r in patterns.match_rules(names, rules).collect()}
    assert got == {"dim_scd": "Copy with data", "x_history": "Skip", "ya_table": "Skip", "yaXtable": "Skip", "plain": None}


def test_create_if_missing_is_idempotent(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS upkeep LOCATION '{tmp_path}/upkeep'")
    for _ in range(2):
        maintenance.create_if_missing(spark, "upkeep.rules", "pattern string, action string")
    assert spark.table("upkeep.rules").count() == 0
    maintenance.snapshot(spark.range(3), "upkeep.copy")
    assert spark.table("upkeep.copy").count() == 3
    spark.sql("DROP DATABASE upkeep CASCADE")


def test_constraint_report(spark):
    df = spark.createDataFrame([(1, "ab", 7), (1, "abc", 8), (None, "a", 7), (None, "a", None)], "id int, t string, f int")
    parent = spark.createDataFrame([(7,)], "k int")
    got = {r["rule"]: r["violations"] for r in maintenance.constraint_report(
        df, ["id"], [["id"]], {"f": (parent, "k")}, {"t": 2}).collect()}
    assert got == {"not null id": 2, "length t": 1, "unique id": 1, "foreign f": 1}


def test_files_are_loaded_once(spark, tmp_path):
    drop, target, checkpoint = (str(tmp_path / x) for x in ("drop", "target", "checkpoint"))
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "a.csv").write_text("v\n1\n")
    assert filedrop.ingest_drop(spark, drop, "v int", target, checkpoint).count() == 1
    (tmp_path / "drop" / "b.csv").write_text("v\n2\n3\n")
    for _ in range(2):
        got = filedrop.ingest_drop(spark, drop, "v int", target, checkpoint)
    assert sorted(r["v"] for r in got.collect()) == [1, 2, 3]


def test_late_hours_are_dropped(spark, tmp_path):
    drop = tmp_path / "events"
    drop.mkdir()
    def run():
        stream = spark.readStream.schema("ts timestamp_ntz, status string").json(str(drop))
        windows = hourly.hourly_counts(stream, "ts", F.col("status") == "Cancelled")
        got = hourly.run_to_folder(windows, str(tmp_path / "out"), str(tmp_path / "cp"))
        return {r["from_ts"].hour: (r["cnt"], r["cancelled_cnt"]) for r in got.collect()}
    (drop / "1.json").write_text('{"ts": "2024-01-01 01:10:00", "status": "ok"}\n{"ts": "2024-01-01 06:10:00", "status": "Cancelled"}\n')
    assert run() == {1: (1, 0), 6: (0, 1)}
    (drop / "2.json").write_text('{"ts": "2024-01-01 01:20:00", "status": "ok"}\n{"ts": "2024-01-01 06:20:00", "status": "ok"}\n')
    assert run() == {1: (1, 0), 6: (1, 1)}


def test_group_fill_rules(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), (None, None), (None, 9.0), ("b", float("nan"))], "k string, v double")
    got = sorted((r["k"] or "", r["v"]) for r in quality.fill_group_mean(df, "v", ["k"]).collect())
    assert got == [("", 4.0), ("", 9.0), ("a", 1.0), ("a", 1.5), ("a", 2.0), ("b", 4.0)]


def test_trims_drop_nulls_and_keep_bounds(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    assert sorted(r["v"] for r in quality.trim_quantile(df, "v", 0.5).collect()) == [1.0, 2.0]
    assert quality.iqr_bounds(df, "v") == (1.75 - 1.5 * 3.0, 4.75 + 1.5 * 3.0)
    empty = df.filter("v > 99")
    assert quality.trim_iqr(empty, "v").count() == 0 and quality.trim_quantile(empty, "v", 0.5).count() == 0
