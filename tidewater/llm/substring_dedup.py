"""Substring dedup by recompression.

A document's words are symbols. Round by round, maximal runs of one symbol become one symbol, then the
alphabet is halved into left and right symbols and every pair of a left symbol before a right one
becomes one symbol. A new symbol's name is a 64-bit hash of what it stands for, so every task gives
equal content the same name and no table of names has to be shared. Equal word sequences get equal
symbols except near their ends; how near is tracked exactly: every symbol carries the span of words
that its name and borders depend on. Each window of `n` words is therefore represented, with all words of
its span, by the longest symbol (of equal ones, that with the least name) of the highest round that has symbols whose span lies
inside the window, and two equal windows always have the same representative. Only windows whose representative turns up in two documents are
compared, by a 128-bit hash of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BROADCAST_ROWS, WordHashes, arrow_rows, broadcast_if_small, mixed, parts, sha, staged, whole_row, words_of

WORDS, ROUNDS = 50, 3
#: Ids are compared as numbers; a document without an id comes after all others.
_LAST = (1 << 63) - 1
_NOTHING = sha([])
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))


def recompress(name: np.ndarray, fixed: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, level: int):
    """One round over all symbols of a part: (name, fixed, low, high, start).

    `fixed` marks separators between documents, which never join anything; [low, high) is the span of
    words a symbol depends on, `start` its first word.
    """
    # Runs. A run's end is known by the symbol behind it, its start by the one before.
    first = np.ones(len(name), bool)
    first[1:] = (name[1:] != name[:-1]) | fixed[1:] | fixed[:-1]
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(name)))
    last = at + size - 1
    before, behind = np.maximum(at - 1, 0), np.minimum(last + 1, len(name) - 1)
    low, high = np.where(fixed[at], low[at], low[before]), np.where(fixed[at], high[last], high[behind])
    salt = np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) & 0xFFFFFFFFFFFFFFFF)
    name = np.where(size > 1, mixed(name[at] + salt) ^ mixed(size.astype(np.uint64) + salt), name[at])
    fixed, start = fixed[at], start[at]
    # Pairs. A left symbol looks at the one behind, a right symbol at the one before.
    left = (mixed(name ^ salt) & np.uint64(1)) == 0
    left, right = left & ~fixed, ~left & ~fixed
    pair = np.zeros(len(name), bool)
    pair[:-1] = left[:-1] & right[1:]
    second = np.zeros(len(name), bool)
    second[1:] = pair[:-1]
    nxt, prv = np.minimum(np.arange(len(name)) + 1, len(name) - 1), np.maximum(np.arange(len(name)) - 1, 0)
    low = np.where(right & ~second, low[prv], low)
    high = np.where(left, high[nxt], high)
    joined = mixed(name + salt) * np.uint64(3) + mixed(name[nxt] ^ salt)
    name = np.where(pair, joined, name)
    keep = ~second
    return name[keep], fixed[keep], low[keep], high[keep], start[keep]


def anchors(hashes: list[np.ndarray], n: int = WORDS, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Representatives of all n-word windows of several documents: (document, first window, last window, name).

    One row per run of windows with the same representative.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    base = np.cumsum(sizes + 1) - sizes  # one separator before each document
    total = int(sizes.sum() + len(sizes)) + 1
    name = np.zeros(total, np.uint64)
    fixed = np.ones(total, bool)
    for b, h in zip(base, hashes):
        name[b : b + len(h)] = h
        fixed[b : b + len(h)] = False
    start = np.arange(total, dtype=np.int64)
    low, high = start.copy(), start + 1
    windows = np.maximum(sizes - n + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), windows)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    p = place + base[doc]
    named = np.zeros(len(p), np.uint64)
    # A symbol is told by its name and by all words of its span; sums of word hashes times powers give any span's hash.
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(name * np.cumprod(np.full(total, _FACTOR)))])
    back = np.cumprod(np.append(np.ones(1, np.uint64), np.full(total, _INVERSE)))
    for level in range(rounds + 1):
        if level:
            name, fixed, low, high, start = recompress(name, fixed, low, high, start, level)
        first, end = np.searchsorted(low, p, "left"), np.searchsorted(high, p + n, "right")
        found = np.flatnonzero(end > first)
        if not len(found):
            break
        words = np.minimum(np.diff(np.append(start, total)), 31).astype(np.uint64)
        span = (upto[high] - upto[low]) * back[low]
        rank = ((np.uint64(31) - words) << np.uint64(58)) | (mixed(mixed(name + np.uint64(level)) ^ span) >> np.uint64(6))
        named[found] = _least(rank, first[found], end[found])
    new = np.flatnonzero(np.append(True, (named[1:] != named[:-1]) | (doc[1:] != doc[:-1]))) if len(p) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(p)) - 1 if len(p) else new
    return doc[new], place[new], place[last], named[new]


def _least(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least of values[first:end] for many ranges, from minima over spans of powers of two."""
    size = np.maximum(np.frexp(end - first)[1] - 1, 0)
    out = np.zeros(len(first), np.uint64)
    span, step = values, 1
    for j in range(int(size.max()) + 1):
        own = np.flatnonzero(size == j)
        out[own] = np.minimum(span[first[own]], span[end[own] - step])
        if len(span) > step:
            span, step = np.minimum(span[:-step], span[step:]), step * 2
    return out


def window_hashes(h: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit polynomial hashes of every n-word window, by doubling the window's length."""
    out = []
    for factor in (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)):
        sums, size = {1: mixed(h ^ factor)}, 1
        power = {1: np.array([factor])}
        while size * 2 <= n:
            a = sums[size]
            sums[size * 2] = a[: len(a) - size] * power[size] + a[size:]
            power[size * 2] = power[size] * power[size]
            size *= 2
        total, done = np.zeros(0, np.uint64), 0
        left, bit = n, size
        while left:
            if bit <= left:
                part = sums[bit][done : done + len(h) - n + 1]
                total = total * power[bit] + part if done else part.copy()
                done += bit
                left -= bit
            bit //= 2
        out.append(mixed(total))
    return out[0], out[1]


def _halves(digest: str) -> tuple[int, int]:
    """The first 128 bits of a hex digest as two signed numbers."""
    return tuple(int.from_bytes(bytes.fromhex(digest[i : i + 16]), "big", signed=True) for i in (0, 16))


def _occurrences(docs: DataFrame, n: int) -> DataFrame:
    """Representatives with the windows that they stand for, and one row per document (name null).

    w1, w2 name the document's whole word sequence, `text_key` its text; `last` of a document's own row
    is its word count.
    """
    fields = [("oid", pa.int64()), ("text_key", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
              ("name", pa.int64()), ("sha", pa.string())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in parts(batches):
            words = [words_of(t) for t in part["text"]]
            digests = [sha(w) for w in words]
            own = np.array([(o, k, *_halves(h)) for o, k, h in zip(part["oid"], part["text_key"], digests)], np.int64).reshape(-1, 4)
            d, first, last, name = anchors([known.of(w) for w in words], n)
            rows, m = np.concatenate([own, own[d]]), len(own)
            yield pa.RecordBatch.from_arrays([
                *(pa.array(rows[:, c]) for c in range(4)),
                pa.array(np.concatenate([np.zeros(m, np.int64), first]).astype(np.int32)),
                pa.array(np.concatenate([np.array([len(w) for w in words], np.int64), last]).astype(np.int32)),
                pa.array(np.concatenate([np.zeros(m, np.int64), name.view(np.int64)]), mask=np.arange(len(rows)) < m),
                pa.array(digests + [None] * len(d), pa.string()),
            ], schema=schema)

    return docs.mapInArrow(run, "oid long, text_key long, w1 long, w2 long, first int, last int, name long, sha string")


def _windows(texts: DataFrame, n: int) -> DataFrame:
    """Hashes of the suspect windows (h1, h2) of each owner's text, and one row with the text itself (place null)."""
    schema = pa.schema([("oid", pa.int64()), ("w1", pa.int64()), ("place", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, done = WordHashes(), set()  # rows repeated with id and text count once
        for part in parts(batches):
            kept, columns = [], [[] for _ in range(5)]
            for text, oid, w1, w2, spans in zip(*(part[c] for c in ("text", "oid", "w1", "w2", "spans"))):
                words = words_of(text)
                if (oid, w1) in done or _halves(sha(words)) != (w1, w2):
                    continue  # or another text under the same id
                done.add((oid, w1))
                kept.append((oid, w1, text))
                h1, h2 = window_hashes(known.of(words), n)
                places = np.unique(np.concatenate([np.arange(s["first"], s["last"] + 1) for s in spans]))
                for column, value in zip(columns, (np.full(len(places), oid, np.int64), np.full(len(places), w1, np.int64), places, h1[places].view(np.int64), h2[places].view(np.int64))):
                    column.append(value)
            if kept:
                yield arrow_rows(schema, dict(zip(schema.names, (*zip(*[(*k[:2], None, None, None, k[2]) for k in kept]),))))
                oid, w1, place, h1, h2 = (np.concatenate(c) for c in columns)
                yield arrow_rows(schema, {"oid": oid, "w1": w1, "place": place.astype(np.int32), "h1": h1, "h2": h2, "text": pa.nulls(len(w1), pa.string())})

    return texts.mapInArrow(run, "oid long, w1 long, place int, h1 long, h2 long, text string")


def _kept(texts: DataFrame, n: int) -> DataFrame:
    """(oid, w1, n_removed, kept_sha, kept) of texts with the places of the windows that go."""
    schema = pa.schema([("oid", pa.int64()), ("w1", pa.int64()), ("n_removed", pa.int64()), ("kept_sha", pa.string()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            out = {f.name: [] for f in schema}
            for text, oid, w1, places in zip(*(part[c] for c in ("text", "oid", "w1", "places"))):
                words = words_of(text)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, places, 1)
                np.add.at(edge, np.array(places) + n, -1)
                stays = np.cumsum(edge)[:-1] == 0
                left = [w for w, s in zip(words, stays) if s]
                for name, value in zip(out, (oid, w1, len(words) - len(left), sha(left), b" ".join(left).decode())):
                    out[name].append(value)
            yield arrow_rows(schema, out)

    return texts.mapInArrow(run, "oid long, w1 long, n_removed long, kept_sha string, kept string")


def find_repeats(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(doc_id, text_key, n_words, n_removed, kept_sha256, kept) for every row of `docs` (doc_id, text).

    A word is removed when a window of `n` words that covers it also starts in a document with a smaller
    doc_id; windows are judged on the input. `kept` is null where nothing is removed. Null texts have no
    words. Rows without an id come after all others and are no smaller than each other. Of documents with
    the same word sequence the smallest id owns it and the others lose everything, if they have a window
    at all; only owners are looked into. Rows of one id are judged each for itself; repeated rows alike.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("oid"), F.xxhash64("text").alias("text_key"), "text")
    found = staged(_occurrences(rows, n))
    own, named = found.filter("name is null"), found.filter("name is not null")
    # Grouped tables are written before they are joined: then a hot key's rows on the other side can be split.
    owners = staged(own.groupBy("w1", "w2").agg(F.min(F.struct("oid", "text_key")).alias("o")).select("w1", "w2", F.col("o.oid").alias("owner"), F.col("o.text_key").alias("owner_key")))
    shared = staged(named.groupBy("name").agg(F.min("w1").alias("a"), F.max("w1").alias("b")).filter("a < b").select("name"))
    suspects = staged(
        named.join(shared, "name").join(owners, ["w1", "w2"]).filter("oid = owner AND text_key = owner_key")
        .groupBy("w1", "w2", "oid", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    )
    # A few spans per suspect document: where they are few in all, no text has to be shuffled to meet them.
    suspects = broadcast_if_small(suspects, F.size("spans").cast("long"), 4 * BROADCAST_ROWS)
    compared = staged(_windows(rows.join(suspects, ["oid", "text_key"]).select("text", "oid", "w1", "w2", "spans"), n))
    windows, texts = compared.filter("place is not null"), compared.filter("place is null").select("oid", "w1", "text")
    earliest = staged(windows.groupBy("h1", "h2").agg(F.min("oid").alias("lo"), F.max("oid").alias("hi")).filter("lo < hi").select("h1", "h2", "lo"))
    gone = windows.join(earliest, ["h1", "h2"]).filter("oid > lo").groupBy("oid", "w1").agg(F.collect_set("place").alias("places"))
    changed = _kept(gone.join(texts.dropDuplicates(["oid", "w1"]), ["oid", "w1"]).select("text", "oid", "w1", "places"), n)
    copy = (F.col("oid") > F.col("owner")) & (F.col("last") >= n)
    return own.join(owners, ["w1", "w2"]).join(changed, ["oid", "w1"], "left").select(
        F.when(F.col("oid") < _LAST, F.col("oid")).alias("doc_id"), "text_key", F.col("last").cast("long").alias("n_words"),
        F.when(copy, F.col("last").cast("long")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(_NOTHING)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def remove_repeats(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """`docs` with repeated words removed from `text` (and n_chars, where there is one, counted anew).

    Texts that lose nothing stay as they are; of the others the kept words are joined by one blank.
    """
    found = (
        find_repeats(docs.select("doc_id", "text"), n).filter("kept is not null")
        .select(F.col("doc_id").alias("id"), "text_key", "kept").dropDuplicates(["id", "text_key"])
    )
    rows = docs.select(whole_row(docs).alias("row"), "doc_id", F.xxhash64("text").alias("key"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("text_key")), "left")
    text = F.coalesce("kept", "row.text")
    new = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return joined.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
