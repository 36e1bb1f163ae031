"""Near copies by SimHash fingerprints and covering locality-sensitive hashing.

The positions of a fingerprint are dealt over the non-zero vectors of r + 1 bits. Each non-zero vector v gives a
mask: the positions whose vector has an odd product with v. Up to r positions span a space in which some v is
orthogonal to all of them; its mask avoids these positions. So two fingerprints that differ in r bits or fewer
agree under one of the 2^(r + 1) - 1 masks at least: no pair within the radius is lost.

A mask keeps about half the bits. A bucket of too many fingerprints is covered again over the bits that its mask
leaves open, which halves them each time; after three rounds at most eight bits are open, so no bucket holds more than
256 different fingerprints. Every bucket that is compared is bounded, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_rows, parts, staged, words_of
from tidewater.llm.components import components

BITS, SHINGLE, SEED, RADIUS = 64, 3, 42, 3
#: Fingerprints of a bucket up to which it is compared rather than covered again.
BUCKET = 256
_BIT_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)
_BYTE_PLACE = 256 * np.arange(8)


def fingerprint(words: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of the word shingles, repeats counted; bits set in over half of their XXH64 hashes."""
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1]
    text, counts = b" ".join(words), np.zeros((8, 256), np.int64)
    for i in range(0, len(starts), 1 << 16):
        a, b = starts[i : i + (1 << 16)].tolist(), ends[i + size - 1 : i + size - 1 + (1 << 16)].tolist()
        h = np.fromiter(map(xxhash.xxh64_intdigest, map(text.__getitem__, map(slice, a, b)), repeat(seed)), np.uint64, len(a))
        counts += np.bincount((h.view(np.uint8).reshape(-1, 8) + _BYTE_PLACE).ravel(), minlength=2048).reshape(8, 256)
    set_in = (counts @ _BIT_OF_BYTE).ravel()
    return int(np.packbits(2 * set_in > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row; fp is the 64-bit fingerprint as a signed long, 0 for a text without words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            made = np.array([fingerprint(words_of(t, lower=True)) for t in part["text"]], np.uint64).view(np.int64)
            yield arrow_rows(_FOUND, {"doc_id": part["doc_id"], "fp": made})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


_FOUND = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def masks(kept: int = 0, radius: int = RADIUS) -> list[int]:
    """Masks that keep the bits of `kept` and cover the others: any `radius` of these are avoided by one mask."""
    free = [i for i in range(BITS) if not kept >> i & 1]
    # Unit vectors first: even a few bits then span everything, so that each mask covers at least one of them.
    vectors = sorted(range(1, 2 ** (radius + 1)), key=lambda v: (v.bit_count() > 1, v))
    vector = {i: vectors[k % len(vectors)] for k, i in enumerate(free)}
    return sorted({kept | sum(1 << i for i in free if (vector[i] & v).bit_count() % 2) for v in vectors})


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Per bucket, each fingerprint with the smallest one that it reaches within the bucket."""
    for batch in batches:
        a, b = [], []
        for members in batch.column(0):
            fp = np.sort(members.values.to_numpy())
            near = np.bitwise_count((fp[:, None] ^ fp[None, :]).view(np.uint64)) <= radius
            label = np.arange(len(fp))
            while True:
                least = np.where(near, label[None, :], len(fp)).min(axis=1)
                if (least == label).all():
                    break
                label = least
            moved = label != np.arange(len(fp))
            a.append(fp[label[moved]])
            b.append(fp[moved])
        if a:
            yield arrow_rows(_LINK, {"a": np.concatenate(a), "b": np.concatenate(b)})


def links(prints: DataFrame, radius: int = RADIUS, most: int = BUCKET) -> DataFrame:
    """(a, b): links of the different fingerprints `fp` that have the components of all pairs within the radius."""
    spark = prints.sparkSession
    found = []
    rows = prints.select(F.lit(0).cast("long").alias("mask"), "fp")
    kept = [0]
    while True:
        # One row per mask of the round before: 15, then at most 225.
        wider = {m: masks(m, radius) for m in kept}
        table = spark.createDataFrame([(_signed(m), [_signed(x) for x in w]) for m, w in wider.items()], "mask long, wider array<long>")
        kept = sorted({x for w in wider.values() for x in w})
        rows = rows.join(F.broadcast(table), "mask").select(F.explode("wider").alias("mask"), "fp")
        if found:  # masks of different rounds can meet in one
            rows = rows.distinct()
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = staged(rows.groupBy("mask", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"))
        found.append(sizes.filter(f"n = 2 AND bit_count(a ^ b) <= {radius}").select("a", "b"))
        shared = staged(rows.join(sizes.filter("n > 2").select("mask", "key", "n"), ["mask", "key"]))
        last = all(2 ** (BITS - m.bit_count()) <= BUCKET for m in kept)
        buckets = shared.filter(F.lit(last) | (F.col("n") <= most)).groupBy("mask", "key").agg(F.collect_list("fp").alias("members"))
        found.append(buckets.select("members").mapInArrow(lambda it: _forest(it, radius), "a long, b long"))
        rows = shared.filter(F.col("n") > most).select("mask", "fp")
        if last or rows.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row: its fingerprint in hex, and the smallest doc_id that links reach.

    Texts are lower-cased (A-Z only); shingles of three words, of all words if there are fewer. Documents link when
    their fingerprints differ in at most `radius` bits. Null, empty and blank texts have fingerprint zero and are
    linked like any other. Rows with a null doc_id take part in links but give no component its name: a component
    of such rows alone has a null one. Repeated rows each come back; columns besides doc_id and text aren't read.
    """
    prints = staged(fingerprints(docs))
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    nodes = components(links(classes.select("fp"), radius)).toDF("fp", "root")
    rooted = staged(classes.join(nodes, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    names = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = staged(rooted.join(names, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
