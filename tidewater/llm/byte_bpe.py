"""Byte-level BPE through a sentencepiece model that is written from a rank file.

The rank file's byte strings become pieces in which every byte is one printable character; a piece's
score is its negated rank, so sentencepiece merges in the order of the ranks. The model normalises
nothing and adds nothing. Texts are cut into pre-tokens first, each of which is encoded alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from tidewater.llm.common import arrow_rows, parts

#: Pre-tokens kept with their ids in each task.
CACHE = 500_000
_RUN = re.compile(r"\s\s")


def byte_characters() -> list[str]:
    """One printable character per byte: itself where it is printable Latin-1, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One protobuf field: numbers as varints, floats as 32 bits, texts and messages with their length."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in the order of their ranks, which must be 0, 1, 2, ..."""
    with open(path, "rb") as file:
        pairs = sorted((int(rank), base64.b64decode(text)) for text, rank in map(bytes.split, filter(None, map(bytes.strip, file))))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have gaps")
    return [text for _, text in pairs]


def model_bytes(pieces: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece i has id i; the unknown piece comes last."""
    chars = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    out = [
        _field(1, _field(1, "".join(chars[b] for b in text)) + _field(2, float(-rank)) + _field(3, normal))
        for rank, text in enumerate(pieces)
    ]
    out.append(_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(pieces) + 1) + _field(40, len(pieces))
    # identity normalisation: no map, no leading blank, blanks neither merged nor escaped
    normaliser = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes and decodes with one rank file. Pre-tokens that are pieces as a whole are one id, as in the rank library."""

    def __init__(self, ranks: str, pattern: str, cache: int = CACHE):
        self.pieces = read_ranks(ranks)
        self.whole = {text: [i] for i, text in enumerate(self.pieces)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.pieces))
        self.split = regex.compile(pattern)
        self.chars = dict(enumerate(byte_characters()))
        self.chunks: dict[str, bytes] = {}
        self.most = cache

    def ids_of(self, tokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token; those that are no piece go through the model together."""
        raw = [t.encode() for t in tokens]
        found = [self.whole.get(r) for r in raw]
        open_ = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(open_, self.model.encode([raw[i].decode("latin-1").translate(self.chars) for i in open_], num_threads=1)):
            found[i] = ids
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as 32-bit numbers.

        A blank between two characters that aren't white space always starts a pre-token, so a text is
        cut there and a chunk's ids are remembered; where white space meets white space the whole text
        is one chunk.
        """
        cut = [t.split(" ") if t and not _RUN.search(t) else [t] if t else [] for t in texts]
        for chunks in cut:
            chunks[1:] = [" " + c for c in chunks[1:]]
        new = list({c for chunks in cut for c in chunks}.difference(self.chunks))
        tokens = [self.split.findall(c) for c in new]
        ids = iter(self.ids_of([t for found in tokens for t in found]))
        fresh = {c: np.array([*chain.from_iterable(islice(ids, len(found)))], np.int32).tobytes() for c, found in zip(new, tokens)}
        if len(self.chunks) + len(fresh) > self.most:
            # Start again with what this part needs.
            self.chunks = {c: self.chunks[c] for chunks in cut for c in chunks if c in self.chunks}
        self.chunks.update(fresh)
        out = [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in cut]
        for c in fresh:
            if len(c) > 64:
                del self.chunks[c]
        return out

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], np.int32).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(ranks: str, pattern: str) -> Codec:
    """The worker's codec, built once per process."""
    if (ranks, pattern) not in _CODECS:
        _CODECS[ranks, pattern] = Codec(ranks, pattern)
    return _CODECS[ranks, pattern]


def encode_texts(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; a null or empty text has no ids. Repeated rows stay repeated."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for part in parts(batches):
            found = own.encode_all(part["text"])
            ends = np.cumsum([0, *map(len, found)], dtype=np.int64) // 4
            ids = pa.ListArray.from_arrays(ends.astype(np.int32), np.frombuffer(b"".join(found), np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(part["doc_id"], pa.int64()), ids], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, ranks: str, pattern: str, with_bytes: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, decoded]) from (doc_id, ids); null ids count as none."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + ([("decoded", pa.binary())] if with_bytes else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        decimal = [str(i) for i in range(len(own.pieces))]
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                out = {f.name: [] for f in schema}
                for doc_id, cell in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = cell.values.to_numpy().tolist() if cell.is_valid else []
                    decoded = own.decode(ids)
                    out["doc_id"].append(doc_id)
                    out["n_tokens"].append(len(ids))
                    out["ids_sha256"].append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                    if with_bytes:
                        out["decoded"].append(decoded)
                yield arrow_rows(schema, out)

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", decoded binary" if with_bytes else "")
    return encoded.select("doc_id", "ids").mapInArrow(run, kind)
