"""Rows without ids or hosts, repeated labelled rows and places in very long texts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import quality_rules, substring_dedup, url_filters
from tidewater.llm.queries import URL_RULES


@pytest.mark.parametrize("rows", [200, 400])
def test_rows_without_an_id_meet_by_text(spark, monkeypatch, rows):
    """One shared passage in all of them: each text is compared once, not once for each of the others."""
    rng, sizes, windows = random.Random(rows), [], substring_dedup._windows
    passage = " ".join(f"p{i}" for i in range(70))
    data = [(None, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) + " " + passage) for _ in range(rows)]
    data += [data[0]] * 3 + [(5, passage), (6, "x " + passage)]
    docs = spark.createDataFrame(data, "doc_id long, text string")

    def counted(texts, n):
        sizes.append(texts.count())
        return windows(texts, n)

    monkeypatch.setattr(substring_dedup, "_windows", counted)
    got = substring_dedup.find_repeats(docs).collect()
    assert sizes == [len(data)]
    removed = {r["doc_id"]: r["n_removed"] for r in got}
    assert len(got) == len(data) and removed == {5: 0, 6: 70, None: 70}
    assert all(r["n_removed"] == 70 for r in got if r["doc_id"] is None)


def test_urls_without_a_host_pass_by(spark):
    urls = [(i, None if i % 3 == 0 else "no scheme" if i % 3 == 1 else f"http://a.example.org/es/{i % 5}") for i in range(300)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = url_filters.filter_urls(pages, url_filters.rules_table(spark, URL_RULES))
    rows = {r["page_id"]: r for r in found.collect()}
    assert len(rows) == 300
    for i, _ in urls:
        want = ("a.example.org", "example.org/es/", "block") if i % 3 == 2 else ("", None, "allow")
        assert (rows[i]["host"], rows[i]["rule"], rows[i]["verdict"]) == want


def test_places_beyond_24_bits(spark):
    places = [3, (1 << 24) + 3, 20_000_000, 20_000_001, (1 << 31) - 5]
    hashes = [1 << 40, 1 << 40, 5 << 50, -(7 << 40), -(7 << 40)]
    packed = sorted((h >> 31 << 31) + i for h, i in zip(hashes, places))
    one = spark.createDataFrame([(packed,)], "packed array<bigint>")
    found = one.select(quality_rules._suspect_places(F.col("packed")).alias("p")).head()["p"]
    assert sorted(found) == [3, (1 << 24) + 3, 20_000_001, (1 << 31) - 5]


def test_repeated_labelled_rows_are_one_trial(spark):
    rows = [(i, " ".join(f"w{i}x{k}" + ("#" if i % 4 == 0 else "") for k in range(60)), "en") for i in range(120)]
    docs = quality_rules.measures(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(120)], "doc_id long, quality int")
    copies = docs.select("*", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("col")
    assert quality_rules.cutoffs(copies, labels).count() == 0  # 90 good documents certify nothing, however often they come
    more = copies.withColumn("doc_id", F.monotonically_increasing_id())
    told = more.select("doc_id", F.when(F.col("n_symbols") > 0, 0).otherwise(1).alias("quality"))
    assert quality_rules.cutoffs(more, told).count() == 1
