"""Scalar-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import arrays, dates, numbers, text
from tidewater.operators import words
from tidewater.registry import job
from tidewater.tables import Tables


@job("fn01_concat_and_format", """
    SELECT s_suppkey, s_name || ' (' || s_nationkey || ')' AS label, 'key ' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS padded,
           concat_ws('-', s_name, CAST(s_nationkey AS VARCHAR)) AS joined FROM supplier
""")
def concat_and_format(t: Tables) -> DataFrame:
    nation = F.col("s_nationkey").cast("string")
    return t.supplier.select("s_suppkey", F.concat("s_name", F.lit(" ("), nation, F.lit(")")).alias("label"),
                             F.format_string("key %06d", "s_suppkey").alias("padded"), F.concat_ws("-", "s_name", nation).alias("joined"))


@job("fn02_slices", r"""
    SELECT p_partkey, left(p_name, 3) AS head, substr(p_name, 2, 4) AS middle, right(p_name, 2) AS tail,
           array_to_string(list_transform(string_split_regex(p_name, '\s+'), lambda w: substr(w, 3, greatest(length(w) - 4, 0))), ' ') AS stripped FROM part
""")
def slices(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.select("p_partkey", F.left(name, F.lit(3)).alias("head"), F.substring(name, 2, 4).alias("middle"),
                         F.right(name, F.lit(2)).alias("tail"), F.array_join(text.strip_each_word(name, 2), " ").alias("stripped"))


@job("fn03_length", "SELECT doc_id, length(text) AS n FROM documents")
def length(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.length("text").cast("long").alias("n"))


@job("fn04_split_pick_join", r"""
    WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents)
    SELECT doc_id, coalesce(w[2], 'no such word') AS second, w[len(w)] AS last_word,
           array_to_string(list_filter(w, lambda x, i: i % 2 = 1), ' ') AS odd, len(list_filter(w, lambda x, i: i % 2 = 0)) AS even_words,
           list_min(list_transform(w[1:5], lambda x: length(x))) AS shortest_of_five FROM w
""")
def split_pick_join(t: Tables) -> DataFrame:
    c = F.col("text")
    return t.documents.select(
        "doc_id", text.nth_word(c, 1, "no such word").alias("second"), text.nth_word(c, -1).alias("last_word"),
        F.array_join(text.odd_words(c), " ").alias("odd"), F.size(text.even_words(c)).cast("long").alias("even_words"),
        F.array_min(F.transform(F.slice(text.words(c), 1, 5), lambda x: F.length(x))).cast("long").alias("shortest_of_five"))


@job("fn05_contains_and_prefix", """
    SELECT doc_id, contains(text, 'the') AS has_the, starts_with(text, 'The') AS starts, contains(lower(text), 'eau') AS has_eau FROM documents
""")
def contains_and_prefix(t: Tables) -> DataFrame:
    c = F.col("text")
    return t.documents.select("doc_id", c.contains("the").alias("has_the"), c.startswith("The").alias("starts"),
                              F.lower(c).contains("eau").alias("has_eau"))


@job("fn06_count_char", "SELECT doc_id, length(text) - length(replace(text, '@', '')) AS ats, length(text) - length(replace(text, '.', '')) AS dots FROM documents")
def count_char(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.count_char(F.col("text"), "@").alias("ats"), text.count_char(F.col("text"), ".").alias("dots"))


@job("fn07_password_rule", r"""
    WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN replace(p_name, ' ', '') || p_size WHEN 1 THEN upper(left(p_name, 1)) || replace(p_name, ' ', '') || p_size
                      WHEN 2 THEN p_name || p_type || p_size ELSE replace(p_name, ' ', '') || p_type END AS pw FROM part)
    SELECT p_partkey, regexp_full_match(pw, '[\p{L}\p{N}]+') AND regexp_matches(pw, '\p{Lu}') AND regexp_matches(pw, '\p{Ll}') AND regexp_matches(pw, '\p{Nd}') AS strong FROM p
""")
def password_rule(t: Tables) -> DataFrame:
    name, size = F.replace("p_name", F.lit(" "), F.lit("")), F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 4
    pw = (F.when(kind == 0, F.concat(name, size)).when(kind == 1, F.concat(F.upper(F.left("p_name", F.lit(1))), name, size))
          .when(kind == 2, F.concat("p_name", "p_type", size)).otherwise(F.concat(name, F.col("p_type"))))
    return t.part.select("p_partkey", text.strong_password(pw).alias("strong"))


@job("fn08_drop_punctuation_upper", r"""
    SELECT doc_id, upper(translate(replace(text, 'ß', 'ss'), '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', '')) AS shout FROM documents
""")
def drop_punctuation(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.shout(F.col("text")).alias("shout"))


_TITLED = "CASE c_custkey % 3 WHEN 0 THEN 'Kelly, Mr. ' || c_name WHEN 1 THEN 'Wilkes, Mrs. ' || c_name ELSE c_name END"


@job("fn09_title_from_name", f"""
    SELECT c_custkey, nullif(regexp_extract({_TITLED}, ' ([A-Za-z]+)\\.', 1), '') AS title FROM customer
""")
def title_from_name(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.title_of(F.expr(_TITLED)).alias("title"))


_PRICED = "concat('Price ', replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING), '.', ','), ' each')"


@job("fn10_number_from_price_text", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS joined_digits,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS second_token FROM lineitem
""")
def number_from_price(t: Tables) -> DataFrame:
    src = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.expr(_PRICED).alias("price"))
    return src.select("l_orderkey", "l_linenumber", "l_partkey", text.joined_digits(F.col("price")).alias("joined_digits"),
                      text.second_token_price(F.col("price")).alias("second_token"))


@job("fn11_longest_replacement_first", """
    SELECT p_partkey, replace(replace(replace(replace(p_name, 'small ring', '#1'), 'small', 'S'), 'ring', 'R'), '#1', 'tiny hoop') AS name FROM part
""")
def longest_replacement(t: Tables) -> DataFrame:
    mapping = {"small": "S", "ring": "R", "small ring": "tiny hoop"}
    return t.part.select("p_partkey", text.replace_longest(F.col("p_name"), mapping).alias("name"))


@job("fn12_map_codes", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS code FROM orders")
def map_codes(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.map_codes(F.col("o_orderstatus"), {"F": 0, "O": 1}).alias("code"))


@job("fn13_encode_decode", "SELECT doc_id, octet_length(encode(text)) AS bytes, decode(encode(text)) AS again FROM documents")
def encode_decode(t: Tables) -> DataFrame:
    raw = F.encode("text", "UTF-8")
    return t.documents.select("doc_id", F.octet_length(raw).cast("long").alias("bytes"), F.decode(raw, "UTF-8").alias("again"))


_DICT = r"""
    WITH dict AS (SELECT DISTINCT unnest(string_split_regex(text, '\s+')) AS w FROM benchmark),
"""


def _dictionary(t: Tables) -> DataFrame:
    """Every word of the benchmark texts with an upper-case partner."""
    w = t.benchmark.select(F.explode(text.words(F.col("text"))).alias("word")).distinct()
    return w.select("word", F.concat(F.upper("word"), F.lit("!")).alias("partner"))


@job("fn14_substitute_words", _DICT + r"""
    tok AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents))
    SELECT doc_id, string_agg(upper(replace(tok.w, 'ß', 'ss')) || '!', ' ' ORDER BY pos) AS text FROM tok JOIN dict ON dict.w = tok.w WHERE tok.w <> '' GROUP BY doc_id
""")
def substitute_words(t: Tables) -> DataFrame:
    return words.substitute_words(t.documents, "doc_id", "text", _dictionary(t), "word", "partner")


@job("fn15_lookup_with_default", _DICT + r"""
    f AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')[1] AS first_word FROM documents)
    SELECT doc_id, first_word, CASE WHEN dict.w IS NULL THEN 'There is no such word' ELSE upper(replace(dict.w, 'ß', 'ss')) || '!' END AS meaning FROM f LEFT JOIN dict ON dict.w = first_word
""")
def lookup_with_default(t: Tables) -> DataFrame:
    first = t.documents.select("doc_id", text.nth_word(F.col("text"), 0).alias("first_word"))
    return words.lookup(first, "first_word", _dictionary(t), "word", "partner", "meaning")


@job("fn16_sentence_per_group", """
    WITH e AS (SELECT DISTINCT c_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' (material - ' || lower(o_orderpriority) || ')' AS e
               FROM customer LEFT JOIN orders ON o_custkey = c_custkey)
    SELECT c_custkey, coalesce('In 1997 the following people bought a wand: ' || string_agg(e, ', ' ORDER BY e) || '.', 'No one was buying magic wands this year.') AS sentence
    FROM e GROUP BY c_custkey
""")
def sentence_per_group(t: Tables) -> DataFrame:
    """One sentence a customer: a customer's orders are a line of bounded length."""
    both = t.customer.select("c_custkey").join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    name = F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd")
    return words.sentence_of(both, "c_custkey", name, F.lower("o_orderpriority"), "1997")


@job("fn17_key_or_value_contains", "SELECT p_partkey, p_type || ': ' || p_name AS line FROM part WHERE contains(p_name, 'ON') OR contains(p_type, 'ON')")
def key_or_value_contains(t: Tables) -> DataFrame:
    hit = text.contains_either(F.col("p_name"), F.col("p_type"), "ON")
    return t.part.filter(hit).select("p_partkey", F.concat_ws(": ", "p_type", "p_name").alias("line"))


@job("fn18_split_names_by_score", """
    SELECT p_partkey, array_to_string(list_filter(names, lambda x, i: scores[i] > 4), ',') AS passed, array_to_string(list_filter(names, lambda x, i: NOT scores[i] > 4), ',') AS failed
    FROM (SELECT p_partkey, string_split(p_name || ' ' || lower(p_type), ' ') AS names, [p_size % 7, p_size % 5 + 1, p_size % 9] AS scores FROM part)
""")
def split_names(t: Tables) -> DataFrame:
    names = F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ")
    scores = F.array(F.col("p_size") % 7, F.col("p_size") % 5 + 1, F.col("p_size") % 9)
    passed, failed = arrays.pick_names_by_score(names, scores, 4)
    return t.part.select("p_partkey", F.array_join(passed, ",").alias("passed"), F.array_join(failed, ",").alias("failed"))


@job("fn19_text_to_matrix", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + l_discount AS first_row, l_tax AS corner, 1 AS unread FROM lineitem")
def text_to_matrix(t: Tables) -> DataFrame:
    raw = F.concat(F.concat_ws(" ", "l_quantity", "l_discount"), F.lit("\n"), F.concat_ws(" ", F.col("l_tax"), F.lit("x")))
    m = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", text.parse_matrix(raw).alias("m"))
    unread = F.size(F.filter(F.flatten("m"), lambda x: x.isNull()))
    return m.select("l_orderkey", "l_linenumber", "l_partkey", arrays.total(F.get("m", F.lit(0))).alias("first_row"),
                    F.get(F.get("m", F.lit(1)), F.lit(0)).alias("corner"), unread.alias("unread"))


@job("fn20_parse_and_truncate_day", "SELECT event_id, date_trunc('day', ts) AS day FROM events")
def parse_day(t: Tables) -> DataFrame:
    as_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.select("event_id", F.date_trunc("day", as_text.cast("timestamp_ntz")).cast("timestamp_ntz").alias("day"))


@job("fn21_date_parts", """
    SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, isodow(o_orderdate) - 1 AS wd, strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%Y-%m') AS ym FROM orders
""")
def date_parts(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.year(d).cast("long").alias("y"), F.month(d).cast("long").alias("m"), dates.weekday(d).cast("long").alias("wd"),
                           F.date_format(d, "MMMM").alias("month_name"), dates.month_label(d).alias("ym"))


@job("fn22_month_start", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mn FROM orders")
def month_start(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("mn"))


@job("fn23_minutes_between", """
    SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / CAST(60000000 AS DOUBLE) AS minutes, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days FROM events
""")
def minutes_between(t: Tables) -> DataFrame:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return t.events.select("event_id", dates.minutes_between(start, F.col("ts")).alias("minutes"),
                           F.datediff("ts", F.lit("2024-01-01")).cast("long").alias("days"))


@job("fn24_date_arithmetic", """
    SELECT o_orderkey, CAST(o_orderdate + INTERVAL 1 DAY AS DATE) AS next_day, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before,
           o_orderdate + INTERVAL 90 MINUTE AS later FROM orders
""")
def date_arithmetic(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.date_add(d, 1).alias("next_day"), F.add_months(d, -1).alias("month_before"),
                           (F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTE")).alias("later"))


_ZONES = "CASE user_id % 3 WHEN 0 THEN 'Asia/Tokyo' WHEN 1 THEN 'America/New_York' END"


@job("fn25_local_time_per_row", f"SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE coalesce({_ZONES}, 'UTC') AS local_ts FROM events")
def local_time(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.local_time(F.col("ts"), F.expr(_ZONES)).cast("timestamp_ntz").alias("local_ts"))


@job("fn26_time_bands", """
    SELECT event_type, count(*) FILTER (WHERE strftime(ts, '%H:%M:%S') >= '21:00:00' OR strftime(ts, '%H:%M:%S') <= '01:00:00') AS night,
           count(*) FILTER (WHERE strftime(ts, '%H:%M:%S') BETWEEN '06:00:00' AND '09:00:00') AS morning FROM events GROUP BY 1
""")
def time_bands(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(
        F.count_if(dates.in_clock_band(F.col("ts"), "21:00:00", "01:00:00")).alias("night"),
        F.count_if(dates.in_clock_band(F.col("ts"), "06:00:00", "09:00:00")).alias("morning"))


@job("fn27_generated_series", """
    SELECT p_partkey, i FROM (SELECT p_partkey, unnest(range(1, p_size + 1)) AS i FROM part)
""")
def generated_series(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.explode(F.sequence(F.lit(1).cast("long"), F.col("p_size").cast("long"))).alias("i"))


@job("fn28_century_and_clock", """
    SELECT o_orderkey, CAST(ceil((year(o_orderdate) - o_orderkey % 300) / 100.0) AS INTEGER) AS century,
           CAST(CASE WHEN o_orderkey % 2 = 1 THEN (o_orderkey % 12 + 1) % 12 + 12 ELSE (o_orderkey % 12 + 1) % 12 END AS BIGINT) AS hour24 FROM orders
""")
def century_and_clock(t: Tables) -> DataFrame:
    half = F.when(F.col("o_orderkey") % 2 == 1, "pm").otherwise("am")
    return t.orders.select("o_orderkey", numbers.century(F.year("o_orderdate") - F.col("o_orderkey") % 300).alias("century"),
                           numbers.to_24h(F.col("o_orderkey") % 12 + 1, half).alias("hour24"))


@job("fn30_safe_ratio", "SELECT l_orderkey, l_linenumber, l_partkey, round(coalesce(l_discount / nullif(l_tax, 0), 0), 6) AS ratio FROM lineitem")
def safe_ratio(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(numbers.safe_ratio(F.col("l_discount"), F.col("l_tax")), 6).alias("ratio"))


@job("fn31_roundings", """
    SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 2, 0) AS half_even, round(l_quantity / 2) AS half_up, floor(l_extendedprice * 10 + 0.5) / 10 AS one_place FROM lineitem
""")
def roundings(t: Tables) -> DataFrame:
    half = F.col("l_quantity") / 2
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", numbers.np_round(half).alias("half_even"), F.round(half).alias("half_up"),
                             numbers.round_half_up(F.col("l_extendedprice"), 1).alias("one_place"))


@job("fn32_quotient_and_remainder", "SELECT o_orderkey, o_orderkey // 7 AS q, o_orderkey % 7 AS r, CAST(trunc(o_totalprice) AS BIGINT) AS whole FROM orders")
def quotient(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", numbers.truncated_div(k, F.lit(7)).alias("q"), (k % 7).alias("r"), F.col("o_totalprice").cast("long").alias("whole"))


@job("fn33_log1p_when_not_negative", """
    SELECT c_custkey, round(CASE WHEN (SELECT min(c_acctbal) FROM customer) >= 0 THEN ln(1 + c_acctbal) ELSE c_acctbal END, 6) AS balance,
           round(CASE WHEN (SELECT min(c_nationkey) FROM customer) >= 0 THEN ln(1 + c_nationkey) ELSE c_nationkey END, 6) AS nation FROM customer
""")
def log1p(t: Tables) -> DataFrame:
    low = t.customer.agg(F.struct(F.min("c_acctbal").alias("b"), F.min("c_nationkey").alias("n"))).scalar()
    def scaled(c: str, least):
        return F.round(F.when(least >= 0, F.log1p(F.col(c))).otherwise(F.col(c)), 6)
    return t.customer.select("c_custkey", scaled("c_acctbal", low["b"]).alias("balance"), scaled("c_nationkey", low["n"]).alias("nation"))


@job("fn34_case_chain", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 AND p_type = 'SMALL' THEN 'odd' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS grade FROM part")
def case_chain(t: Tables) -> DataFrame:
    size = F.col("p_size")
    grade = numbers.first_match((size < 10, "small"), ((size < 30) & (F.col("p_type") == "SMALL"), "odd"), (size < 30, "medium"), default="large")
    return t.part.select("p_partkey", grade.alias("grade"))


@job("fn35_select_with_default", """
    SELECT event_id, CASE WHEN v < 10 THEN 0 WHEN v >= 10 AND v <= 50 THEN 1 WHEN v > 50 THEN 2 ELSE 0 END AS bin FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS v FROM events)
""")
def select_with_default(t: Tables) -> DataFrame:
    v = F.when(F.col("event_id") % 4 != 0, F.col("value"))
    return t.events.select("event_id", numbers.first_match((v < 10, 0), ((v >= 10) & (v <= 50), 1), (v > 50, 2), default=0).alias("bin"))


@job("fn36_unit_scale", "SELECT p_partkey, round(p_retailprice / 4184, 8) AS kcal, round(pi() * sqrt(p_size), 8) AS circle FROM part")
def unit_scale(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(numbers.joules_to_kcal(F.col("p_retailprice")), 8).alias("kcal"),
                         F.round(numbers.circle_from_area(F.col("p_size")), 8).alias("circle"))


@job("fn37_map_range_keys", """
    SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',', CASE WHEN l_discount BETWEEN 0.02 AND 0.05 THEN 'discount' END, CASE WHEN l_tax BETWEEN 0.02 AND 0.05 THEN 'tax' END) AS keys FROM lineitem
""")
def map_range_keys(t: Tables) -> DataFrame:
    m = F.create_map(F.lit("tax"), F.col("l_tax"), F.lit("discount"), F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(arrays.map_keys_in_range(m, 0.02, 0.05), ",").alias("keys"))


@job("fn40_indexed_update", """
    SELECT vec_id, round(list_sum(list_transform(embedding, lambda x, i: CASE WHEN (i - 1) % 3 = 0 THEN 1.0 ELSE CAST(x AS DOUBLE) END)), 6) AS every_third,
           round(list_sum(list_transform(embedding, lambda x, i: CASE WHEN i IN (1, 6, 11) THEN 0.0 ELSE CAST(x AS DOUBLE) END)), 6) AS by_list FROM embeddings
""")
def indexed_update(t: Tables) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    return t.embeddings.select("vec_id", F.round(arrays.total(arrays.set_every(e, 3, F.lit(1.0))), 6).alias("every_third"),
                               F.round(arrays.total(arrays.set_at(e, [0, 5, 10], F.lit(0.0))), 6).alias("by_list"))


@job("fn41_close_positions", """
    SELECT vec_id, array_to_string(list_filter(range(64), lambda i: abs(CAST(embedding[i + 1] AS DOUBLE) - CAST(embedding[64 - i] AS DOUBLE)) < 0.05), ',') AS places FROM embeddings
""")
def close_positions(t: Tables) -> DataFrame:
    e = F.col("embedding")
    places = arrays.close_positions(e, F.reverse(e), 0.05)
    return t.embeddings.select("vec_id", F.array_join(F.transform(places, lambda x: x.cast("string")), ",").alias("places"))


@job("fn42_cosine_and_dot", """
    SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(list_reverse(embedding) AS DOUBLE[])), 6) AS dot,
           round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(list_reverse(embedding) AS DOUBLE[])), 6) AS cosine FROM embeddings
""")
def cosine_and_dot(t: Tables) -> DataFrame:
    e, r = F.col("embedding"), F.reverse("embedding")
    return t.embeddings.select("vec_id", F.round(arrays.dot(e, r), 6).alias("dot"), F.round(arrays.cosine(e, r), 6).alias("cosine"))


@job("fn43_any_all_elementwise", """
    SELECT vec_id, list_max(embedding) > 0.35 AS any_big, list_min(embedding) > -0.3 AS all_above, len(list_filter(range(64), lambda i: embedding[i + 1] < embedding[64 - i])) AS less,
           round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) + CAST(x AS DOUBLE))), 6) AS doubled FROM embeddings
""")
def any_all(t: Tables) -> DataFrame:
    e, r = F.col("embedding"), F.reverse("embedding")
    less = F.size(F.filter(arrays.elementwise_less(e, r), lambda x: x)).cast("long")
    return t.embeddings.select(
        "vec_id", F.exists(e, lambda x: x > 0.35).alias("any_big"), F.forall(e, lambda x: x > -0.3).alias("all_above"), less.alias("less"),
        F.round(arrays.total(arrays.elementwise_add(e, e)), 6).alias("doubled"))


@job("fn44_row_axis_stats", """
    SELECT vec_id, round(list_avg(CAST(embedding AS DOUBLE[])), 8) AS mean, CAST(list_min(embedding) AS DOUBLE) AS lo, CAST(list_max(embedding) AS DOUBLE) AS hi FROM embeddings
""")
def row_axis(t: Tables) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    return t.embeddings.select("vec_id", F.round(arrays.mean(e), 8).alias("mean"), F.array_min(e).alias("lo"), F.array_max(e).alias("hi"))


@job("fn44_column_axis_stats", """
    SELECT pos, round(avg(v), 7) AS mean, min(v) AS lo, max(v) AS hi FROM (SELECT unnest(range(64)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY pos
""")
def column_axis(t: Tables) -> DataFrame:
    cells = t.embeddings.select(F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "v"))
    return cells.groupBy(F.col("pos").cast("long").alias("pos")).agg(F.round(F.avg("v"), 7).alias("mean"), F.min("v").alias("lo"), F.max("v").alias("hi"))


@job("fn45_reshape_stride_reverse", """
    SELECT vec_id, CAST(embedding[17] AS DOUBLE) AS second_row_first, CAST(embedding[4] AS DOUBLE) AS stride_first, len(embedding) // 8 AS strided, CAST(embedding[-1] AS DOUBLE) AS reversed_first,
           len(embedding) AS flat FROM embeddings
""")
def reshape(t: Tables) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    rows, strided = arrays.reshape(e, 16), arrays.stride(e, 3, 8)
    return t.embeddings.select(
        "vec_id", F.get(F.get(rows, F.lit(1)), F.lit(0)).alias("second_row_first"), F.get(strided, F.lit(0)).alias("stride_first"),
        F.size(strided).cast("long").alias("strided"), F.get(F.reverse(e), F.lit(0)).alias("reversed_first"), F.size(F.flatten(rows)).cast("long").alias("flat"))


@job("fn46_last_of_ordered_list", "SELECT l_orderkey, arg_max(l_partkey, (l_linenumber, l_partkey)) AS last_part FROM lineitem GROUP BY 1")
def last_of_ordered(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.max_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("last_part"))


@job("fn47_largest_by_rounded_bound", """
    WITH a AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 10) AS a FROM embeddings)
    SELECT vec_id, round(list_max(list_filter(a, lambda x: round_even(x, 0) <= 1.9)), 6) AS below, round(list_max(list_filter(a, lambda x: round_even(x, 0) >= 1.9)), 6) AS above FROM a
""")
def largest_by_bound(t: Tables) -> DataFrame:
    a = F.transform("embedding", lambda x: x.cast("double") * 10)
    return t.embeddings.select("vec_id", F.round(arrays.largest_rounding_below(a, F.lit(1.9)), 6).alias("below"),
                               F.round(arrays.largest_rounding_above(a, F.lit(1.9)), 6).alias("above"))


@job("fn50_json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.name'), event_type) AS name FROM events")
def json_field(t: Tables) -> DataFrame:
    return t.events.select("event_id", text.json_field(F.col("props"), "k").cast("long").alias("k"),
                           text.json_field(F.col("props"), "name", F.col("event_type")).alias("name"))
