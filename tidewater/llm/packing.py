"""Packing of tokenised documents into sequences by minimum bin slack.

Every document is cut into whole windows of the capacity and one rest. Whole windows are sequences
of their own. Rests are dealt over buckets; in each bucket a subset-sum table over the remaining
lengths (one bit per reachable total) fills window after window as close to the capacity as it can.
"""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm.common import arrow_rows, slices, staged

CAPACITY, END_ID = 2048, 1
#: Rests per bucket, on average.
BUCKET = 16_384
MARKS = string.punctuation


class Recent:
    """A mapping that forgets what wasn't asked for lately: two generations, the older one given up when the younger is full."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict = {}
        self.old: dict = {}

    def learn(self, keys: set, make: Callable[[list], dict]) -> None:
        """Puts all `keys` into the younger generation; `make` is asked for those that are new."""
        rest = keys.difference(self.young)
        new = rest.difference(self.old)
        self.young.update((k, self.old[k]) for k in rest.difference(new))
        self.young.update(make(list(new)))

    def age(self) -> None:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}


class WordIds:
    """Ids of blank-separated chunks as little-endian 32-bit bytes. No merge or pattern of the tokenizer crosses a blank.

    Texts are lower-cased first (A-Z; the tokenizer lower-cases anyway), and each slice of texts is reduced to its
    different chunks. A chunk of letters with marks behind is a pre-token of letters and one of marks, so the letters
    are looked up alone. Runs of plain letters are a pre-token as they are and go straight to the tokenizer's
    model; other runs of letters are encoded in one joined text, whose ids are told apart by word-end marks.
    """

    def __init__(self, path: str, chunks: int = 200_000, stems: int = 300_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab()
        most = max(vocabulary.values()) + 1
        self.ends = np.zeros(most, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.raw = [i.to_bytes(4, "little") for i in range(most)]
        self.chunks, self.stems = Recent(chunks), Recent(stems)

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, new: list[str]) -> dict[str, bytes]:
        """Ids of runs of letters."""
        raw, model = self.raw, self.model
        found = {s: b"".join([raw[t.id] for t in model.tokenize(s)]) for s in new if s.isascii()}
        rest = [s for s in new if not s.isascii()]
        for at in range(0, len(rest), 500):
            some = rest[at : at + 500]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) == len(some):
                own = ids.tobytes()
                found.update(zip(some, map(own.__getitem__, map(slice, [0, *ends[:-1]], ends))))
            else:  # a letter whose lower case isn't one letter
                found.update(zip(some, self._alone(some)))
        return found

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        stems = [t.rstrip(MARKS) for t in new]
        stems = [s.lower() if s.isascii() else s for s in stems]
        letters = list(map(str.isalpha, stems))
        self.stems.learn(set(compress(stems, letters)), self._encode)
        tails = [t[len(s) :] for t, s in zip(new, stems)]
        kinds = list(set(tails))
        tail_ids = dict(zip(kinds, self._alone(kinds)))
        known = self.stems.young
        found = {c: known[s] + tail_ids[t] for c, s, t, alpha in zip(new, stems, tails, letters) if alpha}
        if len(found) < len(new):
            others = [c for c, alpha in zip(new, letters) if not alpha]
            found.update(zip(others, self._alone(others)))
        self.stems.age()
        return found

    def flat_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of all texts in a row; those of text i are ids[bounds[i] : bounds[i + 1]]. Null is empty."""
        # The library's lower-casing misreads slices, so a slice is copied first.
        texts = texts.cast(pa.large_string()).fill_null("").take(pa.array(range(len(texts)), pa.int64()))
        # Strings of special tokens are matched as they stand, so texts that may hold one keep their capitals.
        cut = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
        coded = cut.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.chunks.age()
        self.chunks.learn(set(chunks), self._learn)
        own = [self.chunks.young[c] for c in chunks]
        table = np.frombuffer(b"".join(own), "<u4")
        size = np.fromiter(map(len, own), np.int64, len(own)) // 4
        first = np.cumsum(size) - size
        code = coded.indices.to_numpy()
        sizes = size[code]
        ends = np.cumsum(sizes)
        ids = table[np.repeat(first[code] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        per_text = np.cumsum(np.asarray(pc.list_value_length(cut)))
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], per_text])]

    def ids_of_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text."""
        ids, bounds = self.flat_ids(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def ids_of(self, text: str | None) -> bytes:
        return self.ids_of_all([text])[0]


_WORDS: dict[str, WordIds] = {}


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): windows of `capacity` ids and the rest of each document.

    A null or empty text holds the end id alone. Repeated rows are packed as often as they come.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.binary())] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _WORDS:
            _WORDS[tokenizer] = WordIds(tokenizer)
        known = _WORDS[tokenizer]
        end = np.array([end_id], "<u4").tobytes()
        for part in slices(batches):
            out = {f.name: [] for f in schema}
            ids, bounds = known.flat_ids(part.column(1))
            for doc_id, first, last in zip(part.column(0).to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                raw = ids[first:last].tobytes() + end
                for at in range(0, len(raw), 4 * capacity):
                    own = raw[at : at + 4 * capacity]
                    out["doc_id"].append(doc_id)
                    out["start"].append(at // 4)
                    out["length"].append(len(own) // 4)
                    out["ids_crc32"].append(zlib.crc32(own))
                    out["doc_tokens"].append(len(raw) // 4)
                    if with_ids:
                        out["ids"].append(own)
            yield arrow_rows(schema, out)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, kind)


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that the total is as near to `capacity` as it can be, from below.

    Lengths enter from the longest down, a length with a count in binary shares. Bit t of `reach`
    says that total t can be made; the step at which it first could leads back to the shares used.
    """
    reach, steps = 1, []
    mask = (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, share = min(counts[length], capacity // length), 1
        while left:
            take = min(share, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, share = left - take, share * 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def windows_of(lengths: list[int], capacity: int) -> list[list[int]]:
    """Positions in `lengths` window by window: the longest rest opens a window, the table fills it."""
    queues: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        queues.setdefault(lengths[i], []).append(i)
    counts = {n: len(q) for n, q in queues.items()}
    order, at, out = sorted(counts, reverse=True), 0, []
    while True:
        while at < len(order) and not counts.get(order[at]):
            at += 1
        if at == len(order):
            return out
        first = order[at]
        taken = [queues[first].pop()]
        counts[first] -= 1
        if not counts[first]:
            del counts[first]
        for length, n in fill_window(counts, capacity - first).items() if capacity > first else ():
            taken += [queues[length].pop() for _ in range(n)]
            counts[length] -= n
            if not counts[length]:
                del counts[length]
        out.append(taken)


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET) -> DataFrame:
    """Adds sequence_id and offset to rows with `length` (1 to capacity). An empty table stays empty.

    The rows are numbered and written once, so that numbers stay the same when a task is repeated.
    Whole windows get odd sequence ids. Rests are dealt over ceil(rests / `bucket`) buckets by a hash
    of their number, so equal lengths and copies spread, and a bucket's size doesn't grow with the data.
    """
    numbered = staged(pieces.withColumn("_no", F.monotonically_increasing_id()))
    rest = F.col("length") < capacity
    n = numbered.filter(rest).count()
    buckets = max(1, math.ceil(n / bucket))

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_no", ignore_index=True)
        lengths = rows["length"].tolist()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for k, taken in enumerate(windows_of(lengths, capacity)):
            at = 0
            for i in taken:
                sequence[i], offset[i] = ((int(key[0]) << 32) + k) * 2, at
                at += lengths[i]
        return pd.DataFrame({"_no": rows["_no"], "sequence_id": sequence, "offset": offset})

    placed = (
        numbered.filter(rest).select("_no", "length", F.pmod(F.xxhash64("_no"), F.lit(buckets)).alias("_bucket"))
        .groupBy("_bucket").applyInPandas(fill, "_no long, sequence_id long, offset long")
    )
    whole = numbered.filter(~rest).select("*", (F.col("_no") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return numbered.filter(rest).join(placed, "_no").unionByName(whole).drop("_no")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document with their place; see `pieces_of` and `pack`."""
    return pack(pieces_of(docs, tokenizer, capacity), capacity).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
