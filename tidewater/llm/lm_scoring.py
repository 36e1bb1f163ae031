"""Language-model scores by context-tree weighting over bytes, beside a unigram base.

A text is its words in lower case (A-Z only), joined by blanks and ended by a line feed. Each byte is
coded as eight binary decisions; each decision has a tree over the bytes before, up to `DEPTH` of them.
A tree node holds a Krichevsky-Trofimov estimate of its counts and, from the counts of the nodes below,
the weight that context-tree weighting gives to stopping there. Counting, the weights level by level
and the probability of every distinct byte sequence are Spark jobs over all nodes. Tasks sum whole
texts with the commonest sequences; the other sequences of a text are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WordHashes, mixed, parts, remainder, staged, words_of

DEPTH = 5
#: Byte sequences whose probabilities every task knows, at most and the commonest; the others are joined.
COMMON = 1 << 19
#: Words with at least this share of the training tokens (at most 1 / WORD_SHARE of them) are known to every task; rarer ones are joined.
WORD_SHARE = 2.0**-18
#: Distinct byte sequences a task gathers before it hands them on, and slots to look up the commonest ones.
GATHERED, SLOTS = 2_000_000, 1 << 21


def stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + b"\n"


def sequences(streams: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """Each byte of the streams with the `depth` bytes before it, as one number; before a text stand line feeds."""
    joined = b"".join(b"\n" * depth + s for s in streams)
    a = np.frombuffer(joined, np.uint8)
    out = np.zeros(len(a) - depth if len(a) else 0, np.int64)
    for i in range(depth + 1):
        out = (out << 8) | a[i : len(a) - depth + i]
    sizes = np.array([len(s) for s in streams], np.int64)
    starts = np.cumsum(sizes + depth) - (sizes + depth)
    own = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return out[own]


def _counts(docs: DataFrame, by: int, depth: int) -> DataFrame:
    """(kind, key, n, learnt), added up per task: byte sequences (0) of all documents, word hashes (1) and end tokens (2) of the training documents.

    `learnt` is the part of n that comes from training documents.
    """
    schema = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("n", pa.int64()), ("learnt", pa.int64())])

    def merged(old: tuple, keys: np.ndarray) -> tuple:
        k, n = np.unique(keys, return_counts=True)
        if len(old[0]):
            k, at = np.unique(np.concatenate([old[0], k]), return_inverse=True)
            n = np.bincount(at, np.concatenate([old[1], n]), len(k)).astype(np.int64)
        return k, n

    def rows(kind: int, found: tuple, learnt: bool = True) -> pa.RecordBatch:
        n = found[1].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int8)), pa.array(found[0]), pa.array(n), pa.array(n * learnt)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, none = WordHashes(), (np.zeros(0, np.int64), np.zeros(0, np.int64))
        found, ends = [none, none, none], 0
        kinds = ((0, True), (1, True), (0, False))
        for part in parts(batches):
            learnt = [bool(remainder(i, by)) for i in part["doc_id"]]
            words = [words_of(t, lower=True) for t in part["text"]]
            train = [w for w, yes in zip(words, learnt) if yes]
            ends += len(train)
            found[0] = merged(found[0], sequences([stream(w) for w in train], depth))
            found[1] = merged(found[1], np.concatenate([known.of(w) for w in train] or [np.zeros(0, np.uint64)]).view(np.int64))
            found[2] = merged(found[2], sequences([stream(w) for w, yes in zip(words, learnt) if not yes], depth))
            for i, (kind, own) in enumerate(kinds):
                if len(found[i][0]) > GATHERED:
                    yield rows(kind, found[i], own)
                    found[i] = none
        for i, (kind, own) in enumerate(kinds):
            yield rows(kind, found[i], own)
        yield rows(2, (np.zeros(1, np.int64), np.array([ends])))

    return docs.select("doc_id", "text").mapInArrow(run, "kind byte, key long, n long, learnt long")


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1/2: Stirling's series seven steps up."""
    product, y = x, x + 7
    for i in range(1, 7):
        product = product * (x + i)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _log_kt() -> Column:
    zero, one = F.col("n0").cast("double"), F.col("n1").cast("double")
    return _log_gamma(zero + 0.5) + _log_gamma(one + 0.5) - _log_gamma(zero + one + 1) - math.log(math.pi)


def tree_levels(counted: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """Per context length 0..depth: (context, node, n0, n1, pw, stop).

    pw is the logarithm of the weighted probability of all the node's decisions, stop the weight that
    the node's own estimate has against the nodes one byte longer; the longest contexts always stop.
    Sequences counted 0 times get nodes that change no other node's weight.
    """
    byte = F.col("key").bitwiseAND(255)
    steps = F.array(*[
        F.struct((F.lit(1 << j) + F.shiftright(byte, 8 - j)).cast("int").alias("node"), F.shiftright(byte, 7 - j).bitwiseAND(1).cast("int").alias("bit"))
        for j in range(8)
    ])
    decisions = counted.select(F.shiftright("key", 8).alias("context"), "n", F.inline(steps))
    half = math.log(0.5)
    level = decisions.groupBy("context", "node").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"))
    level = staged(level.withColumn("pw", _log_kt()).withColumn("stop", F.lit(1.0)))
    levels = [level]
    for d in range(depth - 1, -1, -1):
        level = (
            level.withColumn("context", F.col("context").bitwiseAND((1 << 8 * d) - 1)).groupBy("context", "node")
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("pw").alias("below"))
            .withColumn("own", _log_kt() + half).withColumn("below", F.col("below") + half)
            .withColumn("most", F.greatest("own", "below"))
            .withColumn("pw", F.col("most") + F.log(F.exp(F.col("own") - F.col("most")) + F.exp(F.col("below") - F.col("most"))))
            .select("context", "node", "n0", "n1", "pw", F.exp(F.col("own") - F.col("pw")).alias("stop"))
        )
        level = staged(level)
        levels.insert(0, level)
    return levels


def sequence_scores(levels: list[DataFrame], seqs: DataFrame) -> DataFrame:
    """`seqs` (key, n) with ln, the logarithm of P(last byte | bytes before); every sequence must have gone into `levels`.

    From the shortest contexts on, each node takes over from the node above what is mixed so far and the
    weight that is left. A node counted 0 times has the probability of the node above.
    """
    one = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
    seen = F.col("n0") + F.col("n1") > 0
    above = None
    for d, level in enumerate(levels):
        if above is None:
            level = level.withColumns({"up_p": F.lit(0.5), "up_mixed": F.lit(0.0), "up_rest": F.lit(1.0)})
        else:
            up = above.select(F.col("context").alias("up"), "node", *[F.col(c).alias(f"up_{c}") for c in ("p", "mixed", "rest")])
            level = level.withColumn("up", F.col("context").bitwiseAND((1 << 8 * (d - 1)) - 1)).join(up, ["up", "node"])
        mixed_, rest = F.col("up_mixed") + F.col("up_rest") * F.col("stop") * one, F.col("up_rest") * (1 - F.col("stop"))
        above = level.select(
            "context", "node", F.when(seen, mixed_ + rest * one).otherwise(F.col("up_p")).alias("p"),
            F.when(seen, mixed_).otherwise(F.col("up_mixed")).alias("mixed"), F.when(seen, rest).otherwise(F.col("up_rest")).alias("rest"))
    # At most 255 nodes and 256 bytes for a context.
    nodes = above.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct("node", "p"))).alias("nodes"))
    held = seqs.groupBy(F.shiftright("key", 8).alias("context")).agg(F.collect_list(F.struct("key", "n")).alias("own"))
    byte, ln = F.col("key").bitwiseAND(255), F.lit(0.0)
    for j in range(8):
        p = F.element_at("nodes", (F.lit(1 << j) + F.shiftright(byte, 8 - j)).cast("int"))
        ln = ln + F.log(F.when(F.shiftright(byte, 7 - j).bitwiseAND(1) == 1, p).otherwise(1 - p))
    return held.join(nodes, "context").select("nodes", F.inline("own")).select("key", "n", ln.alias("ln"))


def commonest(scores: DataFrame, most: int) -> DataFrame:
    """The rows of `scores` with the largest n, down to a size that leaves at most `most` of them."""
    size = F.floor(F.log2("n") * 8)
    least, total = math.inf, 0
    for r in sorted(scores.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):  # at most 8 x 63 rows
        total += r["count"]
        if total > most:
            break
        least = r["size"]
    return scores.filter(size >= F.lit(float(least)))


class ContextTrees:
    """All nodes of small trees as sorted arrays per context length, and the code length of byte sequences: the plain form of `sequence_scores`."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = []
        for keys, one, stop in levels:
            order = np.argsort(keys)
            self.levels.append((keys[order], one[order], stop[order]))

    def log_probability(self, seq: np.ndarray) -> np.ndarray:
        """ln P(last byte | bytes before) of distinct sequences."""
        byte, total = seq & 255, np.zeros(len(seq))
        for j in range(8):
            node, bit = (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1
            p, rest, deepest, alive = np.zeros(len(seq)), np.ones(len(seq)), np.full(len(seq), 0.5), np.arange(len(seq))
            for d, (keys, one, stop) in enumerate(self.levels):
                if not len(alive) or not len(keys):
                    break
                key = (((seq[alive] >> 8) & ((1 << 8 * d) - 1)) << 8) | node[alive]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                alive, at = alive[hit], at[hit]
                deepest[alive] = one[at]
                p[alive] += rest[alive] * stop[at] * one[at]
                rest[alive] *= 1 - stop[at]
            p += rest * deepest
            total += np.log(np.where(bit == 1, p, 1 - p))
        return total


class SequenceScores:
    """ln probabilities of the commonest byte sequences: a table of fixed size, behind it a sorted list for keys that share a slot."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, slots: int = SLOTS):
        order = np.argsort(keys)
        self.sorted, self.ln, self.mask = keys[order], values[order], np.uint64(slots - 1)
        self.keys, self.values = np.full(slots, -1, np.int64), np.zeros(slots)
        slot = (mixed(self.sorted.view(np.uint64)) & self.mask).astype(np.int64)
        slot, first = np.unique(slot, return_index=True)
        self.keys[slot], self.values[slot] = self.sorted[first], self.ln[first]

    def of(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences' values, 0 for those not among the commonest, and the places of these."""
        out, missing = np.zeros(len(seq)), []
        for start in range(0, len(seq), 1 << 20):
            some = seq[start : start + (1 << 20)]
            slot = (mixed(some.view(np.uint64)) & self.mask).astype(np.int64)
            value, wrong = self.values[slot], np.flatnonzero(self.keys[slot] != some)
            at = np.minimum(np.searchsorted(self.sorted, some[wrong]), max(len(self.sorted) - 1, 0))
            hit = self.sorted[at] == some[wrong] if len(self.sorted) else np.zeros(len(wrong), bool)
            value[wrong] = np.where(hit, self.ln[at], 0.0) if len(self.sorted) else 0.0
            out[start : start + len(some)] = value
            missing.append(start + wrong[~hit])
        return out, np.concatenate(missing or [np.zeros(0, np.int64)])


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


def score_documents(docs: DataFrame, by: int = 10, depth: int = DEPTH) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    Learns from documents whose crc32(doc_id as text) modulo `by` is not 0; a null id counts as the
    empty text and is held out. A null or empty text is its end token alone. Both scores are log10
    probabilities. Repeated rows are learnt from and scored as often as they come. With nothing to
    learn from, every decision has one half and the base is one token in one.

    The driver holds the commonest byte sequences and words, a bounded number of each; all others are
    looked up by a join.
    """
    spark = docs.sparkSession
    counted = staged(_counts(docs, by, depth).groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("learnt").alias("learnt")))
    words = counted.filter("kind = 1").select("key", "n")
    totals = counted.agg(
        F.coalesce(F.sum(F.when(F.col("kind") > 0, F.col("n"))), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum((F.col("kind") == 1).cast("long")), F.lit(0)).alias("words"),
        F.coalesce(F.sum(F.when(F.col("kind") == 2, F.col("n"))), F.lit(0)).alias("ends"),
    ).head()
    distinct = totals["words"] + (1 if totals["ends"] else 0)
    norm = totals["tokens"] + 0.1 * (distinct + 1)

    seqs = counted.filter("kind = 0").select("key", "n", "learnt")
    sequence = staged(sequence_scores(tree_levels(seqs.select("key", F.col("learnt").alias("n")), depth), seqs.select("key", "n")))
    top = commonest(sequence, COMMON).select("key", "ln").toArrow()
    common = words.filter(F.col("n") >= max(1, totals["tokens"] * WORD_SHARE)).orderBy("key").toArrow()
    shared = spark.sparkContext.broadcast((top["key"].to_numpy(), top["ln"].to_numpy(), common["key"].to_numpy(), common["n"].to_numpy()))
    ends = totals["ends"]

    # A row for each text, for each of its rarer words, and for each of its distinct rarer byte sequences with the times it comes.
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
                        ("score", pa.float64()), ("word", pa.int64()), ("seq", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *best, keys, counts = shared.value
        scores, known = SequenceScores(*best), WordHashes()
        logs, end = np.log10((counts + 0.1) / norm), math.log10((ends + 0.1) / norm)
        row = TaskContext.get().partitionId() << 33
        for part in parts(batches):
            words = [words_of(t, lower=True) for t in part["text"]]
            sizes = np.array([len(w) for w in words], np.int64)
            h = np.concatenate([known.of(w) for w in words]).view(np.int64)
            at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
            hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
            base = _sums(np.where(hit, logs[at] if len(keys) else 0.0, 0.0), sizes) + end
            n_known = _sums(hit.astype(np.float64), sizes).round().astype(np.int64) + (ends > 0)
            streams = [stream(w) for w in words]
            lengths = np.array([len(s) for s in streams], np.int64)
            seq = sequences(streams, depth)
            ln, missing = scores.of(seq)
            score = _sums(ln, lengths) / math.log(10)
            rows = row + np.arange(len(words))
            row += len(words)
            rare = np.flatnonzero(~hit)
            held, seq = np.repeat(rows, lengths)[missing], seq[missing]
            order = np.lexsort((seq, held))
            held, seq = held[order], seq[order]
            first = np.flatnonzero(np.append(True, (np.diff(held) != 0) | (np.diff(seq) != 0))[: len(seq)])
            values = {
                "row": (rows, np.repeat(rows, sizes)[rare], held[first]), "n_tokens": (sizes + 1, None, None), "n_known": (n_known, None, None),
                "base": (base, None, None), "score": (score, None, None), "word": (None, h[rare], None), "seq": (None, None, seq[first]),
                "times": (None, None, np.diff(np.append(first, len(seq)))),
            }
            amounts = (len(rows), len(rare), len(first))
            arrays = []
            for field in schema:
                if field.name == "doc_id":
                    arrays.append(pa.array(part["doc_id"] + [None] * (len(rare) + len(first)), pa.int64()))
                    continue
                mask = np.repeat([v is None for v in values[field.name]], amounts)
                arrays.append(pa.array(np.concatenate([np.zeros(n, np.int64) if v is None else v for v, n in zip(values[field.name], amounts)]), field.type, mask=mask))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    kind = ", ".join(f"{f.name} {'double' if f.name in ('base', 'score') else 'long'}" for f in schema)
    scored = staged(docs.select("doc_id", "text").mapInArrow(run, kind))
    seen = F.coalesce("n", F.lit(0))
    rare = (
        scored.filter("word is not null").select("row", F.col("word").alias("key")).join(words, "key", "left")
        .groupBy("row").agg(F.sum(F.log10((seen + 0.1) / norm)).alias("rare"), F.sum((seen > 0).cast("long")).alias("rare_known"))
    )
    joined = (
        scored.filter("seq is not null").select("row", F.col("seq").alias("key"), "times").join(sequence.select("key", "ln"), "key")
        .groupBy("row").agg((F.sum(F.col("times") * F.col("ln")) / math.log(10)).alias("joined"))
    )
    return scored.filter("word is null and seq is null").join(rare, "row", "left").join(joined, "row", "left").select(
        "doc_id", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % by == 0).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(totals["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("joined", F.lit(0.0))).alias("score"),
    )
