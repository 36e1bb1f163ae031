"""Words, stable hashes and staged tables shared by the operators of this package."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import shared_dir

#: Text bytes that one numpy pass works on; longer single texts are passes of their own.
PASS_BYTES = 4 << 20
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def staged(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lost executors cost a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows up to which a written table may be broadcast; beyond that its join shuffles.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, weight=None, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, to be broadcast if it has at most `most` rows (or elements, counted by the column `weight`); it should be staged."""
    size = df.agg(F.coalesce(F.sum(weight), F.lit(0)) if weight is not None else F.count(F.lit(1))).head()[0]
    return F.broadcast(df) if size <= most else df


def whole_row(df: DataFrame):
    """All columns as one struct, so that an operator's own columns can't clash with theirs."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 words `[^\\x20\\x09-\\x0D]+`; bytes.split() splits at exactly these six bytes. `lower` maps A-Z only."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.translate(_LOWER) if lower else raw).split()


class WordHashes(dict):
    """word -> 64-bit hash, filled as words turn up; forgotten when it holds `most` words."""

    def __init__(self, seed: int = 0, most: int = 400_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def remainder(doc_id: int | None, by: int) -> int:
    """crc32 of the id's decimal text, modulo `by`; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % by


def remainder_col(doc_id, by: int):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about `most` bytes of `text`: bounded memory whatever the row length."""
    for batch in batches:
        rows = batch.num_rows
        lengths = [0 if v is None else v for v in pa.compute.binary_length(batch.column(batch.schema.get_field_index(text))).to_pylist()]
        start, size = 0, 0
        for i in range(rows):
            size += lengths[i]
            if size >= most or i == rows - 1:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0


def parts(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = PASS_BYTES) -> Iterator[dict[str, list]]:
    """The same slices, as lists by column."""
    return (part.to_pydict() for part in slices(batches, text, most))


def arrow_rows(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
