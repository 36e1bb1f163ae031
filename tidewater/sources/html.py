"""Extraction from stored pages: titles, links, images, table rows, body text, records by class.

A page is parsed once per call with the standard library's parser, inside Arrow batches; Spark
splits the pages, into tasks of a bounded number of them however they lie in files. Everything
after the cut into rows is plain column work.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# HTML elements without an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

#: Pages that one task may get before they are dealt anew.
PAGES = 5_000


class _Page(HTMLParser):
    """Collects what the extractors need in one walk."""

    def __init__(self, card_class: str | None = None, fields: Mapping[str, tuple[str, str | None]] | None = None):
        super().__init__(convert_charrefs=True)
        self.title: str | None = None
        self.links: list[list] = []
        self.images: list[str] = []
        self.rows: list[list] = []
        self.body: list[str] = []
        self.cards: list[dict] = []
        self._open: list[str] = []
        self._link = self._row = self._cell = None
        self._table = -1
        self._card_class, self._fields = card_class, fields or {}
        self._card_at = 0
        self._capture: dict[str, int] = {}

    def updatepos(self, i, j):
        return j  # lines aren't counted: no extractor asks for a place in the text

    def _within(self, tag: str) -> bool:
        return tag in self._open

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if tag not in VOID:
            self._open.append(tag)
        depth = len(self._open)
        if tag == "title" and self.title is None:
            self.title = ""
        elif tag == "a":
            self._link = [at.get("href"), ""]
            self.links.append(self._link)
        elif tag == "img" and at.get("src") is not None:
            self.images.append(at["src"])
        elif tag == "table":
            self._table += 1
        elif tag == "tr":
            self._row = [max(self._table, 0), []]
            self.rows.append(self._row)
        elif tag == "td" and self._row is not None:
            self._row[1].append("")
            self._cell = True
        if self._card_class is not None:
            names = (at.get("class") or "").split()
            if not self._card_at and self._card_class in names:
                self.cards.append({})
                self._card_at = depth
            elif self._card_at:
                for field, (want, cls) in self._fields.items():
                    fits = tag == want and (cls is None or set(cls.split()) <= set(names))
                    if fits and field not in self.cards[-1]:
                        self.cards[-1][field] = ""
                        self._capture[field] = depth

    def handle_endtag(self, tag):
        if tag not in self._open:
            return
        while self._open:
            depth = len(self._open)
            last = self._open.pop()
            self._capture = {f: d for f, d in self._capture.items() if d < depth}
            if self._card_at == depth:
                self._card_at = 0
            if last == "a":
                self._link = None
            elif last == "td":
                self._cell = None
            elif last == "tr":
                self._row = self._cell = None
            if last == tag:
                break

    def handle_data(self, data):
        if self._within("script") or self._within("style"):
            return
        if self._within("title") and not self._within("body"):
            self.title = (self.title or "") + data
            return
        if self._link is not None:
            self._link[1] += data
        if self._cell and self._row is not None:
            self._row[1][-1] += data
        if self._within("body"):
            self.body.append(data)
        for field in self._capture:
            self.cards[-1][field] += data


def _parse(html: str | None, **spec) -> _Page:
    page = _Page(**spec)
    page.feed(html or "")
    page.close()
    return page


def dealt(rows: DataFrame, most: int | None = None) -> DataFrame:
    """The same rows in tasks of about `most` at most (PAGES, unless given).

    Parsing costs far more than reading: a small file, or one row group, can hold hours of it for a single task.
    The rows of each task are counted first, which reads no column; rows that lie well are not shuffled.
    """
    most = most or PAGES
    sizes = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.agg(F.max("n").alias("largest"), F.sum("n").alias("n")).first()
    # Dealt in turn, not by key, so that a frequent key doesn't matter.
    return rows.repartition(math.ceil(size["n"] / most)) if (size["largest"] or 0) > 1.2 * most else rows


def _each_page(pages: DataFrame, key: str, html: str, schema: str, cut, **spec) -> DataFrame:
    """Run `cut(page) -> list of tuples` over every page; `schema` describes the tuple."""
    kind = dict(pages.dtypes)[key]
    names = [key] + [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for pdf in batches:
            out = [(k, *row) for k, text in zip(pdf[key], pdf[html]) for row in cut(_parse(text, **spec))]
            yield pd.DataFrame(out, columns=names)

    return dealt(pages.select(key, html)).mapInPandas(run, f"{key} {kind}, {schema}")


def extract_titles(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, title); pages without a title are left out."""
    found = _each_page(pages, key, html, "title string", lambda p: [] if p.title is None else [(p.title,)])
    return found.select(key, F.trim("title").alias("title"))


def extract_links(pages: DataFrame, key: str = "page_id", html: str = "html", suffix: str | None = None) -> DataFrame:
    """(key, pos, href, text) in page order; `suffix` keeps targets such as '.html'."""
    found = _each_page(pages, key, html, "pos int, href string, text string",
                       lambda p: [(i, href, text) for i, (href, text) in enumerate(p.links) if href is not None])
    found = found.withColumn("text", F.trim("text"))
    return found.filter(F.col("href").endswith(suffix)) if suffix else found


def extract_images(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return _each_page(pages, key, html, "pos int, src string", lambda p: list(enumerate(p.images)))


def extract_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, table_no, row_no, cells): trimmed td texts; rows without td are left out."""
    found = _each_page(
        pages, key, html, "table_no int, row_no int, cells array<string>",
        lambda p: [(t, i, cells) for i, (t, cells) in enumerate(r for r in p.rows if r[1])])
    return found.withColumn("cells", F.transform("cells", lambda c: F.trim(c)))


def extract_body(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, body, body_length) without script and style text."""
    found = _each_page(pages, key, html, "body string", lambda p: [("".join(p.body),)])
    return found.withColumn("body_length", F.length("body").cast("long"))


def extract_records(pages: DataFrame, card_class: str, fields: Mapping[str, tuple[str, str | None]],
                    key: str = "page_id", html: str = "html", missing: str | None = "") -> DataFrame:
    """One row per element of class `card_class`; `fields` maps a name to (tag, class or None).

    A field that a card lacks gets `missing`, so the columns of a card stay together.
    """
    names = list(fields)
    schema = "card_no int, " + ", ".join(f"{n} string" for n in names)
    return _each_page(
        pages, key, html, schema,
        lambda p: [(i, *[c.get(n, missing) for n in names]) for i, c in enumerate(p.cards)],
        card_class=card_class, fields=dict(fields))


def text_number_pairs(rows: DataFrame, text_at: int, number_at: int) -> DataFrame:
    """(…, name, number) from two cell positions; rows whose number is unreadable are left out."""
    keep = [c for c in rows.columns if c != "cells"]
    got = rows.select(*keep, F.get("cells", F.lit(text_at)).alias("name"),
                      F.get("cells", F.lit(number_at)).try_cast("double").alias("number"))
    return got.filter(F.col("number").isNotNull())


def first_number(body: DataFrame, key: str = "page_id") -> DataFrame:
    """The first token of the body that is all digits, as a number; pages without one are left out."""
    found = F.regexp_extract("body", r"(?:^|\s)(\d+)(?=\s|$)", 1).try_cast("long")
    return body.select(key, found.alias("number")).filter(F.col("number").isNotNull())


def top_rated(rows: DataFrame, name_at: int, rating_at: int, key: str = "page_id") -> DataFrame:
    """Rows with the best rating of their page (all ties), one per name and rating over all pages."""
    named = text_number_pairs(rows, name_at, rating_at)
    # The rows of one page fit in that page, so its best ones are taken as a list; pages are parsed once.
    by_rating = named.groupBy(key, "number").agg(F.collect_set("name").alias("_names"))
    best = by_rating.groupBy(key).agg(F.max_by(F.struct("number", "_names"), "number").alias("_b"))
    return best.select(key, "_b.number", F.explode("_b._names").alias("name")).groupBy("name", "number").agg(
        F.min(key).alias("first_page"))


def pick_columns(rows: DataFrame, name_at: int, needle: str, columns: Mapping[str, int], wanted: Sequence[str]) -> DataFrame:
    """Rows whose name contains `needle` (case ignored), with the wanted columns in the asked order."""
    hit = F.lower(F.get("cells", F.lit(name_at))).contains(needle.lower())
    keep = [c for c in rows.columns if c != "cells"]
    return rows.filter(hit).select(*keep, F.get("cells", F.lit(name_at)).alias("name"),
                                   *[F.get("cells", F.lit(columns[w])).alias(w) for w in wanted])
