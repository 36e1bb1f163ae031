"""Periodic runs of words: recursive frequency splitting, then lag scans of what survives.

A run that repeats its period four times or more holds each of its words four times at least. So a word
that occurs more rarely in a segment can't be in any run there and splits it; the parts are counted anew
until nothing splits. Most text is gone by then. Each surviving segment is scanned lag by lag: a run of
period q that is four periods long contains two equal neighbouring blocks of q words that begin at a
multiple of q, and prefix hashes compare those blocks without reading them. Hits are extended word by word,
so hashes decide nothing alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_rows, mixed, parts, words_of

#: A run has at least so many periods, and at least so many words.
PERIODS, LEAST = 4, 6
#: Rounds of splitting after which segments are scanned as they are; the scan is exact for any segment.
ROUNDS = 64
_BASE = np.uint64(0x9E3779B97F4A7C15)


def segments(ids: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of stretches, each within one owner, whose words all occur often enough in them for a run."""
    at = np.arange(len(ids))
    part = owner.astype(np.int64)
    span = np.int64(ids.max() + 1 if len(ids) else 1)
    for _ in range(ROUNDS):
        _, back, count = np.unique(part * span + ids[at], return_inverse=True, return_counts=True)
        frequent = count[back] >= PERIODS
        settled = bool(frequent.all())
        at, part = at[frequent], part[frequent]
        if not len(at):
            return []
        first = np.ones(len(at), bool)
        first[1:] = (np.diff(at) != 1) | (np.diff(part) != 0)
        part = np.cumsum(first) - 1
        long = np.bincount(part)[part] >= LEAST
        settled &= bool(long.all())
        at, part = at[long], part[long]
        if settled or not len(at):
            break
    starts = np.flatnonzero(np.diff(part, prepend=-1)) if len(at) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(at))
    return [(int(at[s]), int(at[e - 1]) + 1) for s, e in zip(starts, ends)]


def _agreeing(w: np.ndarray, i: int, q: int, step: int) -> int:
    """How many places from i on (in steps of 1 or -1) hold the word that stands q places later."""
    total, size = 0, 64
    while True:
        if step > 0:
            a = w[i + total : min(i + total + size, len(w) - q)]
            b = w[i + total + q : i + total + q + len(a)]
        else:
            top = i - total + 1
            low = max(top - size, 0)
            a, b = w[low:top][::-1], w[low + q : top + q][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return total + int(differ[0])
        total += len(a)
        if len(a) < size:
            return total
        size *= 2


class _Known:
    """Runs found so far, by period."""

    def __init__(self):
        self.by_period: dict[int, tuple[list[int], list[int]]] = {}

    def add(self, start: int, end: int, period: int) -> None:
        starts, ends = self.by_period.setdefault(period, ([], []))
        starts.append(start)
        ends.append(end)

    def outside(self, at: np.ndarray, q: int) -> np.ndarray:
        """The places whose next 2 q words aren't wholly in a run whose period divides q."""
        for period, (starts, ends) in self.by_period.items():
            if len(at) and q % period == 0 and period < q:
                i = np.searchsorted(starts, at, "right") - 1
                at = at[(i < 0) | (np.asarray(ends)[i] < at + 2 * q)]
        return at


def lag_scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in the words `w` (integers), by period and start."""
    n = len(w)
    with np.errstate(over="ignore"):
        power = np.ones(n + 1, np.uint64)
        power[1:] = np.cumprod(np.full(n, _BASE | np.uint64(1)))
        sums = np.zeros(n + 1, np.uint64)
        sums[1:] = np.cumsum(mixed(w.astype(np.uint64) + np.uint64(1)) * power[:n])
    found, known = [], _Known()
    for q in range(1, n // PERIODS + 1):
        at = np.arange(0, n - 2 * q + 1, q)
        at = at[w[at] == w[at + q]]
        if not len(at):
            continue
        with np.errstate(over="ignore"):
            same = (sums[at + q] - sums[at]) * power[q] == sums[at + 2 * q] - sums[at + q]
        at = known.outside(at[same], q)
        i = 0
        while i < len(at):
            a = int(at[i])
            right = _agreeing(w, a, q, 1)
            i += 1
            if right < q:  # equal hashes of different blocks
                continue
            start = a - (_agreeing(w, a - 1, q, -1) if a else 0)
            end = a + right + q
            if end - start >= max(LEAST, PERIODS * q):
                found.append((start, end - start, q))
                known.add(start, end, q)
                if end - start == n:
                    return found  # any longer period here would be a multiple of this one
            i = int(np.searchsorted(at, end - 2 * q, "right"))
    return found


def runs_in(ids: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period; none crosses from one owner to the next."""
    found = [(s + start, length, q) for s, e in segments(ids, owner) for start, length, q in lag_scan(ids[s:e])]
    return sorted(found, key=lambda r: (r[0], r[2]))


_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("text", pa.string())])


def find_runs(docs: DataFrame, rewrite: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, text) per row: its periodic runs, by start and period, and the text without their repetitions.

    Words are `[^\\x20\\x09-\\x0D]+`. A run is a stretch with smallest period q, of at least 4 q and at least 6
    words, that can't be extended. `text` has the words that no run contains after its first q, joined by one
    space. `rewrite(doc_id, n)` may give places: word i of the text is then its original word places[i].
    Null and empty texts have no words and no runs. Each row stands for itself, so null and repeated ids are
    as good as others; columns besides doc_id and text aren't read. Work in a text grows with n log n.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            number: dict[bytes, int] = {}
            texts, ids = [], []
            for doc_id, text in zip(part["doc_id"], part["text"]):
                words = words_of(text)
                places = rewrite(doc_id, len(words)) if rewrite and words else None
                if places is not None:
                    words = list(map(words.__getitem__, places.tolist()))
                texts.append(words)
                ids.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
            sizes = np.array([len(x) for x in ids])
            first = np.concatenate([[0], np.cumsum(sizes)])
            found = runs_in(np.concatenate(ids), np.repeat(np.arange(len(ids)), sizes))
            mine = np.searchsorted([r[0] for r in found], first)
            runs, kept = [], []
            for i, words in enumerate(texts):
                own = [(start - int(first[i]), length, q) for start, length, q in found[mine[i] : mine[i + 1]]]
                if own:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for start, length, q in own:
                        edge[start + q] += 1
                        edge[start + length] -= 1
                    words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                kept.append(b" ".join(words).decode())
            yield arrow_rows(_ARROW, {"doc_id": part["doc_id"], "n_words": sizes, "runs": runs, "text": kept})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def with_digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_runs, the longest run, digests of the runs and of the remaining text) of `find_runs` rows.

    The longest run is the one of greatest length, then smallest start, then smallest period; its four columns
    are null where there is none.
    """
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("_longest", longest).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        F.expr("-_longest.s").alias("start"), F.expr("_longest.n").alias("length"), F.expr("-_longest.p").alias("period"),
        F.expr("1000 * _longest.n div -_longest.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )
