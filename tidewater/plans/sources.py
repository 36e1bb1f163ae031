"""Source, sink, streaming, page and table-upkeep queries.

Each one writes what it reads from the given tables, so its work grows with them. Every run takes a
new folder under the shared one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions.numbers import exact_sum
from tidewater.operators import maintenance, signal
from tidewater.operators.patterns import match_rules
from tidewater.registry import job
from tidewater.session import shared_dir
from tidewater.sources import files, html
from tidewater.streaming import filedrop, hourly
from tidewater.tables import Tables


def _own_files(t: Tables, name: str) -> str:
    """A pattern that a stream can read a table by, whether it is one file or a folder of files."""
    path = t.spark._jvm.org.apache.hadoop.fs.Path(f"{t.folder}/{name}.parquet")
    fs = path.getFileSystem(t.spark._jsc.hadoopConfiguration())
    return f"{t.folder}/{name}.parquet" if fs.getFileStatus(path).isDirectory() else f"{t.folder}/{name}.parquet*"


def new_folder(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@job("sr01_semicolons_and_decimal_commas", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def decimal_commas(t: Tables) -> DataFrame:
    path = new_folder(t, "sr01")
    text = F.replace(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    files.write_delimited(t.customer.select("c_custkey", "c_name", text.alias("c_acctbal")), path, sep=";")
    return files.read_delimited(t.spark, path, "c_custkey long, c_name string, c_acctbal double", sep=";", decimal=",")


@job("sr02_without_header", """
    SELECT split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, CAST(c_custkey % 90 AS INTEGER) AS age, c_acctbal AS amount_1,
           CAST(c_nationkey AS DOUBLE) AS amount_2, 0.5::DOUBLE AS amount_3 FROM customer
""")
def without_header(t: Tables) -> DataFrame:
    path = new_folder(t, "sr02")
    name = F.split("c_name", "#")
    t.customer.select(F.get(name, F.lit(0)), F.get(name, F.lit(1)), F.col("c_custkey") % 90, "c_acctbal", "c_nationkey", F.lit(0.5)).write.csv(path, header=False)
    return files.read_headerless(t.spark, path, schemas.PEOPLE)


@job("sr03_old_code_page", "SELECT c_custkey, concat('Клиент ', c_mktsegment) AS label FROM customer")
def old_code_page(t: Tables) -> DataFrame:
    path = new_folder(t, "sr03")
    with files.java_charsets(t.spark):
        t.customer.select("c_custkey", F.concat(F.lit("Клиент "), "c_mktsegment").alias("label")).write.csv(path, header=True, encoding="windows-1251")
    return files.read_delimited(t.spark, path, "c_custkey long, label string", encoding="windows-1251")


def _flight_columns() -> list[str]:
    """Lines as flights, in the column order of the flight schema."""
    given = {
        "year": "year(l_shipdate)", "month": "month(l_shipdate)", "flight_dt": "date_format(l_shipdate, 'yyyy-MM-dd')", "carrier_code": "l_returnflag",
        "tail_num": "concat('N', l_suppkey)", "carrier_flight_num": "cast(l_orderkey AS string)", "origin_code": "cast(l_suppkey % 40 AS string)",
        "dest_code": "cast(l_partkey % 40 AS string)", "dep_delay_min": "l_quantity - 20", "arr_delay_min": "l_quantity - 25",
        "cancelled_flg": "CASE WHEN l_discount = 0.1 THEN 1.0 ELSE 0.0 END", "cancellation_code": "CASE WHEN l_discount = 0.1 THEN 'B' END", "flights_cnt": "1.0", "distance": "l_extendedprice"}
    out = []
    for part in schemas.FLIGHTS.replace("\n", " ").split(","):
        name, kind = part.split()
        out.append(f"CAST({given.get(name, 'NULL')} AS {kind}) AS {name}")
    return out


_FLIGHT_SQL = """
    SELECT l_returnflag AS carrier_code, count(*) AS flights, CAST(sum(CASE WHEN l_discount = 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS cancelled,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS distance, count(*) FILTER (WHERE l_discount <> 0.1) AS empty_codes FROM lineitem {where} GROUP BY 1
"""


def _flight_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("carrier_code").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(F.col("cancelled_flg") == 1).alias("cancelled"), exact_sum("distance").alias("distance"),
        F.count_if(F.col("cancellation_code").isNull()).alias("empty_codes"))


@job("sr04_typed_bulk_load", _FLIGHT_SQL.format(where=""))
def typed_bulk_load(t: Tables) -> DataFrame:
    path = new_folder(t, "sr04")
    t.lineitem.selectExpr(*_flight_columns()).write.csv(path, header=True)
    # The table is dropped and made anew: loading twice leaves one copy.
    table, folder = f"flights_{uuid.uuid4().hex}", new_folder(t, "sr04-table")
    for _ in range(2):
        loaded = files.load_table(t.spark, path, schemas.FLIGHTS, table, folder)
    return _flight_totals(loaded)


@job("sr05_land_one_month_twice", _FLIGHT_SQL.format(where="WHERE year(l_shipdate) = 1997 AND month(l_shipdate) = 3"))
def land_one_month(t: Tables) -> DataFrame:
    """Every month goes to its own drop folder; one month is landed twice and stays whole."""
    drop, landing = new_folder(t, "sr05-drop"), new_folder(t, "sr05-land")
    label = F.date_format(F.make_date("year", "month", F.lit(1)), "yyyy-MM")
    t.lineitem.selectExpr(*_flight_columns()).withColumn("m", label).write.partitionBy("m").csv(drop, header=True)
    for _ in range(2):
        files.land_month(t.spark, drop + "/m={month}", "1997-03", schemas.FLIGHTS, landing)
    return _flight_totals(files.load_month(t.spark, landing, "1997-03"))


@job("sr06_load_when_present", "SELECT * FROM supplier")
def load_when_present(t: Tables) -> DataFrame:
    """Two runs over the same drop folder load each file once."""
    drop, target, checkpoint = (new_folder(t, f"sr06-{x}") for x in ("drop", "target", "checkpoint"))
    t.supplier.write.csv(drop, header=True)
    schema = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    filedrop.ingest_drop(t.spark, drop, schema, target, checkpoint)
    return filedrop.ingest_drop(t.spark, drop, schema, target, checkpoint)


@job("sr07_json_write_read_pick", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS second_type FROM events")
def json_round_trip(t: Tables) -> DataFrame:
    path = new_folder(t, "sr07")
    k = F.get_json_object("props", "$.k").cast("long")
    tags = F.array(*[F.struct(x.alias("inputType")) for x in (F.lit("first"), F.col("event_type"))])
    t.events.select("event_id", F.struct(k.alias("k")).alias("props"), tags.alias("tresholds")).write.json(path)
    df = files.read_json(t.spark, path, "event_id long, props struct<k: long>, tresholds array<struct<inputType: string>>", multi_line=False)
    return files.pick_from_array(df, "tresholds", 1, "inputType", "second_type").select("event_id", F.col("props.k").alias("k"), "second_type")


@job("sr08_text_overwrite_append", "SELECT p_name AS value, count(*) * 2 AS cnt FROM part GROUP BY 1")
def text_append(t: Tables) -> DataFrame:
    path = new_folder(t, "sr08")
    lines = t.part.select(F.col("p_name").alias("value"))
    files.write_lines(lines, path)
    files.write_lines(lines, path, append=True)
    return files.read_lines(t.spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("cnt"))


@job("sr09_csv_write_with_header", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def csv_write(t: Tables) -> DataFrame:
    path = new_folder(t, "sr09")
    files.write_delimited(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), path)
    return files.read_delimited(t.spark, path, "o_orderkey long, o_orderpriority string, o_totalprice double")


@job("sr10_inline_rows_joined", """
    SELECT o_orderkey, weight FROM orders JOIN (VALUES ('1-URGENT', 10), ('2-HIGH', 5)) w(priority, weight) ON priority = o_orderpriority
""")
def inline_rows(t: Tables) -> DataFrame:
    weights = files.inline_rows(t.spark, [("1-URGENT", 10), ("2-HIGH", 5)], "priority string, weight int")
    return t.orders.join(F.broadcast(weights), F.col("priority") == F.col("o_orderpriority")).select("o_orderkey", "weight")


@job("sr11_snapshot_copy", "SELECT * FROM nation JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) ON c_nationkey = n_nationkey")
def snapshot_copy(t: Tables) -> DataFrame:
    path = new_folder(t, "sr11")
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    t.nation.join(counts, F.col("c_nationkey") == F.col("n_nationkey")).write.parquet(path)
    return t.spark.read.parquet(path)


@job("sr13_saved_model_restores_rows", "SELECT vec_id, true AS same FROM embeddings")
def saved_model(t: Tables) -> DataFrame:
    model, scores = new_folder(t, "sr13-model"), new_folder(t, "sr13-scores")
    fit = signal.pca_fit(t.embeddings, "embedding", 64)
    fit.to_frame(t.spark).write.parquet(model)
    signal.pca_transform(t.embeddings, "embedding", fit).select("vec_id", "scores").write.parquet(scores)
    again = signal.Components.from_frame(t.spark.read.parquet(model))
    back = signal.pca_inverse(t.spark.read.parquet(scores), "scores", again).join(t.embeddings, "vec_id")
    close = F.forall(F.zip_with("embedding", "restored", lambda a, b: F.abs(a - b) < 1e-6), lambda x: x)
    return back.select("vec_id", close.alias("same"))


@job("q37_monthly_flight_load", _FLIGHT_SQL.format(where="WHERE year(l_shipdate) = 1998 AND month(l_shipdate) = 5"))
def monthly_flight_load(t: Tables) -> DataFrame:
    """Drop, wait-and-load as a file stream, then the month's totals."""
    drop, target, checkpoint = (new_folder(t, f"q37-{x}") for x in ("drop", "target", "checkpoint"))
    month = t.lineitem.filter((F.col("l_shipdate") >= F.lit("1998-05-01").cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")))
    month.selectExpr(*_flight_columns()).write.csv(drop, header=True)
    return _flight_totals(filedrop.ingest_drop(t.spark, drop, schemas.FLIGHTS, target, checkpoint))


@job("ss01_hourly_stream_with_running_totals", """
    SELECT date_trunc('hour', ts) AS from_ts, count(*) FILTER (WHERE event_type <> 'error') AS cnt, count(*) FILTER (WHERE event_type = 'error') AS cancelled_cnt,
           CAST(sum(count(*) FILTER (WHERE event_type <> 'error')) OVER (ORDER BY date_trunc('hour', ts)) AS BIGINT) AS cum_cnt,
           CAST(sum(count(*) FILTER (WHERE event_type = 'error')) OVER (ORDER BY date_trunc('hour', ts)) AS BIGINT) AS cum_cancelled_cnt
    FROM events GROUP BY 1
""")
def hourly_stream(t: Tables) -> DataFrame:
    stream = t.spark.readStream.schema(t.events.schema).parquet(_own_files(t, "events"))
    windows = hourly.hourly_counts(stream, "ts", F.col("event_type") == "error")
    hours = new_folder(t, "ss01-hours")
    hourly.run_to_folder(windows, hours, new_folder(t, "ss01-checkpoint"))
    done = hourly.running_totals_to_folder(t.spark, hours, new_folder(t, "ss01-totals"), new_folder(t, "ss01-state"))
    return done.select(F.col("from_ts").cast("timestamp_ntz").alias("from_ts"), "cnt", "cancelled_cnt", "cum_cnt", "cum_cancelled_cnt")


@job("ss02_file_drop_stream", "SELECT c_mktsegment, count(*) AS cnt, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total FROM customer GROUP BY 1")
def file_drop_stream(t: Tables) -> DataFrame:
    """Files that come in two deliveries are each loaded once."""
    drop, target, checkpoint = (new_folder(t, f"ss02-{x}") for x in ("drop", "target", "checkpoint"))
    schema = "c_custkey long, c_mktsegment string, c_acctbal double"
    src = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    for half in (0, 1):
        src.filter(F.col("c_custkey") % 2 == half).write.mode("append").csv(drop, header=True)
        loaded = filedrop.ingest_drop(t.spark, drop, schema, target, checkpoint)
    return loaded.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("cnt"), exact_sum("c_acctbal").alias("total"))


@job("hx01_titles", "SELECT page_id, trim(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&quot;', '\"'), '&amp;', '&')) AS title FROM pages")
def titles(t: Tables) -> DataFrame:
    return html.extract_titles(t.pages)


_LINKS = """
    WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS x FROM pages)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, replace(replace(h[i], '&quot;', '"'), '&amp;', '&') AS href, trim(replace(replace(x[i], '&quot;', '"'), '&amp;', '&')) AS text
    FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM l)
"""


@job("hx02_links", _LINKS)
def links(t: Tables) -> DataFrame:
    return html.extract_links(t.pages)


@job("hx02_links_by_suffix", f"SELECT * FROM ({_LINKS}) WHERE href LIKE '%e'")
def links_by_suffix(t: Tables) -> DataFrame:
    return html.extract_links(t.pages, suffix="e")


def _catalog_pages(t: Tables) -> DataFrame:
    """One page per part: price number, images, a table with a head row, and two cards, one without a price."""
    p = {c: F.col(c).cast("string") for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size")}
    price = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    rating = (F.col("p_partkey") % 10).cast("string")
    def row(*cells):
        return F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit("<td> "), c, F.lit(" </td>"))], F.lit("</tr>"))
    page = F.concat(
        F.lit("<html><head><title>"), p["p_name"], F.lit("</title></head><body><p>Price "), p["p_size"], F.lit(" rub 7 </p><img src=\"/img/"), p["p_partkey"],
        F.lit(".png\"><IMG alt='x' src='/img/logo.png'/><table><tr><th>name</th><th>director</th><th>rating</th></tr>"),
        row(p["p_name"], p["p_brand"], rating), row(p["p_type"], F.lit("A &amp; B"), F.lit("5")), row(F.lit("none"), F.lit(""), F.lit("n/a")),
        F.lit("</table><div class=\"book\"><a>"), p["p_name"], F.lit("</a><div class=\"author\">"), p["p_brand"],
        F.lit("</div><div class=\"placement\">hall "), p["p_size"], F.lit("</div><div class=\"title_data price\">Цена "), price,
        F.lit("</div></div><div class='book'><a>Second</a><span class=address></span></div><script>var a = '9 9';</script></body></html>"))
    # Parts are dealt to the tasks while they are small, before they become pages.
    return html.dealt(t.part).select(F.col("p_partkey").alias("page_id"), page.alias("html"))


@job("hx03_images", """
    SELECT p_partkey AS page_id, 0 AS pos, '/img/' || p_partkey || '.png' AS src FROM part UNION ALL SELECT p_partkey, 1, '/img/logo.png' FROM part
""")
def images(t: Tables) -> DataFrame:
    return html.extract_images(_catalog_pages(t))


@job("hx04_table_rows", """
    SELECT p_partkey AS page_id, 0 AS row_no, p_name || '|' || p_brand || '|' || (p_partkey % 10) AS cells FROM part
    UNION ALL SELECT p_partkey, 1, p_type || '|A & B|5' FROM part UNION ALL SELECT p_partkey, 2, 'none||n/a' FROM part
""")
def table_rows(t: Tables) -> DataFrame:
    return html.extract_rows(_catalog_pages(t)).select("page_id", "row_no", F.array_join("cells", "|").alias("cells"))


@job("hx05_top_pairs", """
    SELECT name, number, page_id FROM (SELECT p_name AS name, CAST(p_partkey % 10 AS DOUBLE) AS number, p_partkey AS page_id FROM part UNION ALL SELECT p_type, 5.0, p_partkey FROM part)
    ORDER BY number DESC, name, page_id LIMIT 3
""")
def top_pairs(t: Tables) -> DataFrame:
    pairs = html.text_number_pairs(html.extract_rows(_catalog_pages(t)), 0, 2)
    return pairs.orderBy(F.col("number").desc(), "name", "page_id").limit(3).select("name", "number", "page_id")


@job("hx06_smallest_first_number", "SELECT min(p_size) AS number, arg_min(p_partkey, (p_size, p_partkey)) AS page_id FROM part")
def smallest_number(t: Tables) -> DataFrame:
    numbers = html.first_number(html.extract_body(_catalog_pages(t)))
    return numbers.agg(F.min("number").cast("int").alias("number"), F.min_by("page_id", F.struct("number", "page_id")).alias("page_id"))


@job("hx07_top_rated_rows", """
    WITH r AS (SELECT p_partkey AS page_id, p_name AS name, CAST(p_partkey % 10 AS DOUBLE) AS number FROM part UNION ALL SELECT p_partkey, p_type, 5.0 FROM part)
    SELECT name, number, min(page_id) AS first_page FROM r WHERE number = (SELECT max(number) FROM r x WHERE x.page_id = r.page_id) GROUP BY name, number
""")
def top_rated(t: Tables) -> DataFrame:
    return html.top_rated(html.extract_rows(_catalog_pages(t)), 0, 2).orderBy(F.col("number").desc(), "name")


@job("hx08_pick_columns_by_name", "SELECT p_partkey AS page_id, p_name AS name, CAST(p_partkey % 10 AS VARCHAR) AS rating, p_brand AS director FROM part WHERE contains(lower(p_name), 'ring')")
def pick_columns(t: Tables) -> DataFrame:
    rows = html.extract_rows(_catalog_pages(t))
    got = html.pick_columns(rows, 0, "RING", {"director": 1, "rating": 2}, ["rating", "director"])
    return got.select("page_id", "name", "rating", "director")


@job("hx09_body_text", """
    WITH b AS (SELECT page_id, regexp_replace(regexp_extract(html, '<body>(.*)$', 1, 's'), '<!--.*?-->|<[^>]+>', '', 'gs') AS b FROM pages)
    SELECT page_id, length(x) AS body_length, md5(x) AS digest
    FROM (SELECT page_id, replace(replace(replace(replace(b, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS x FROM b)
""")
def body_text(t: Tables) -> DataFrame:
    return html.extract_body(t.pages).select("page_id", "body_length", F.md5(F.encode("body", "UTF-8")).alias("digest"))


@job("hx10_records_by_class", """
    SELECT p_partkey AS page_id, 0 AS card_no, p_name AS title, p_brand AS author, 'hall ' || p_size AS place, 'Цена ' || CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part
    UNION ALL SELECT p_partkey, 1, 'Second', '', '', '' FROM part
""")
def records_by_class(t: Tables) -> DataFrame:
    return html.extract_records(_catalog_pages(t), "book", {
        "title": ("a", None), "author": ("div", "author"), "place": ("div", "placement"), "price": ("div", "title_data price")})


@job("tm01_upsert_one_column", """
    WITH n AS (SELECT p_partkey * 2 AS k, upper(p_name) AS name, p_type AS description FROM part)
    SELECT coalesce(p_partkey, k) AS k, CASE WHEN p_partkey IS NULL THEN name ELSE p_name END AS name, CASE WHEN k IS NULL THEN p_brand ELSE description END AS description
    FROM part FULL JOIN n ON k = p_partkey
""")
def upsert(t: Tables) -> DataFrame:
    base = t.part.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_brand").alias("description"))
    new = t.part.select((F.col("p_partkey") * 2).alias("k"), F.upper("p_name").alias("name"), F.col("p_type").alias("description"))
    return maintenance.upsert(base, new, "k", ["description"])


@job("tm02_delete_smallest_key", "SELECT * FROM orders WHERE o_orderkey <> (SELECT min(o_orderkey) FROM orders)")
def delete_smallest(t: Tables) -> DataFrame:
    return maintenance.delete_min(t.orders, "o_orderkey")


@job("tm04_create_if_missing", "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name FROM supplier")
def create_if_missing(t: Tables) -> DataFrame:
    """Made twice, filled once: the second statement finds the table and leaves its rows."""
    table, rows = f"suppliers_{uuid.uuid4().hex}", t.supplier.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name")
    folder = new_folder(t, "tm04")
    maintenance.create_if_missing(t.spark, table, rows.schema, folder)
    rows.write.insertInto(table)
    maintenance.create_if_missing(t.spark, table, rows.schema, folder)
    return t.spark.table(table)


@job("tm03_insert_from_scalars", """
    SELECT s_suppkey AS trip, s_nationkey AS ord, s_suppkey AS city, 10 AS days FROM supplier
    UNION ALL SELECT (SELECT min(s_suppkey) FROM supplier), coalesce((SELECT min(s_nationkey) FROM supplier), 0) + 1, (SELECT max(c_custkey) FROM customer), 5
""")
def insert_from_scalars(t: Tables) -> DataFrame:
    base = t.supplier.select(F.col("s_suppkey").alias("trip"), F.col("s_nationkey").alias("ord"), F.col("s_suppkey").alias("city"), F.lit(10).alias("days"))
    row = maintenance.next_row(
        t.spark, trip=t.supplier.agg(F.min("s_suppkey")).scalar(), ord=F.coalesce(t.supplier.agg(F.min("s_nationkey")).scalar(), F.lit(0)) + 1,
        city=t.customer.agg(F.max("c_custkey")).scalar(), days=F.lit(5))
    return base.unionByName(row)


@job("tm05_constraint_report", """
    SELECT 'not null l_orderkey' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM lineitem
    UNION ALL SELECT 'length l_returnflag', count(*) FILTER (WHERE length(l_returnflag) > 1) FROM lineitem
    UNION ALL SELECT 'unique l_orderkey,l_linenumber', CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
    UNION ALL SELECT 'foreign l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'SMALL')
""")
def constraint_report(t: Tables) -> DataFrame:
    return maintenance.constraint_report(
        t.lineitem, not_null=["l_orderkey"], unique=[["l_orderkey", "l_linenumber"]], max_length={"l_returnflag": 1},
        foreign={"l_partkey": (t.part.filter("p_type <> 'SMALL'"), "p_partkey")})


@job("tm06_keys_for_new_rows", """
    SELECT s_name, s_acctbal, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_acctbal, s_name) AS k FROM supplier
""")
def keys_for_new_rows(t: Tables) -> DataFrame:
    base = t.customer.select(F.col("c_custkey").alias("k"))
    return maintenance.assign_ids(base, t.supplier.select("s_name", "s_acctbal"), "k", [F.col("s_acctbal"), F.col("s_name")]).select("s_name", "s_acctbal", "k")


@job("tm07_copy_by_rules", """
    SELECT 'lineitem' AS name, 'Copy with data' AS action, count(*) AS copied FROM lineitem UNION ALL SELECT 'orders', 'Copy schema', 0
    UNION ALL SELECT 'supplier', 'Copy with data', count(*) FROM supplier
""")
def copy_by_rules(t: Tables) -> DataFrame:
    names = t.spark.createDataFrame([("lineitem",), ("orders",), ("supplier",), ("part",), ("nation",)], "name string")
    rules = t.spark.createDataFrame([("%item", "Copy with data"), ("o%s", "Copy schema"), ("part", "Skip"), ("supp_ier", "Copy with data")], "pattern string, action string")
    target = new_folder(t, "tm07")
    done = maintenance.apply_rules(t.spark, match_rules(names, rules), lambda n: f"{t.folder}/{n}.parquet", lambda n: f"{target}/{n}")
    out = None
    for name, action in done:
        if action == "Skip":
            continue
        one = t.spark.read.parquet(f"{target}/{name}").agg(F.count(F.lit(1)).alias("copied")).select(F.lit(name).alias("name"), F.lit(action).alias("action"), "copied")
        out = one if out is None else out.unionByName(one)
    return out
