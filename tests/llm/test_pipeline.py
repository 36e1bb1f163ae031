"""Each stage of the pipeline against a plain form of its contract, on what the stage before kept."""

from __future__ import annotations

import collections
import hashlib
import importlib.util
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_text_operators import linked, repeats
from tests.llm.fixtures import words
from tidewater.llm.common import staged

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], FOLDER)))
    return out


def test_filters_only_drop_rows(steps):
    for before, after in zip(steps[:3], steps[1:4]):
        assert after.columns == before.columns
        rows = collections.Counter(tuple(r) for r in after.collect())
        assert not rows - collections.Counter(tuple(r) for r in before.collect())
    assert [s.count() for s in steps[:4]] == sorted((s.count() for s in steps[:4]), reverse=True)


def test_filters_keep_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    more = docs
    for c in ("score", "predicted", "kept", "n_words", "stratum", "row"):
        more = more.selectExpr("*", f"concat('{c}', doc_id) AS `{c}`")
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.keep_quality):
        after = stage(spark, more, FOLDER)
        assert after.columns == more.columns
        rows = after.collect()
        assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in more.columns[len(docs.columns) :])


def test_near_copies(steps):
    before = [(r["doc_id"], r["text"]) for r in steps[2].collect()]
    want = sorted(i for i, _, c in linked(before) if i == c)
    assert sorted(r["doc_id"] for r in steps[3].collect()) == want and len(want) < len(before)


def test_repeated_passages(steps):
    want = {i: h for i, _, _, h in repeats([(r["doc_id"], r["text"]) for r in steps[3].collect()], 50)}
    got = {r["doc_id"]: r for r in steps[4].collect()}
    assert {i: hashlib.sha256(b" ".join(words(r["text"]))).hexdigest() for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_packing(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for r in steps[4].collect():
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")
        want.update((r["doc_id"], at, zlib.crc32(ids[at : at + 2048].tobytes())) for at in range(0, len(ids), 2048))
    assert collections.Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in steps[5].collect()) == want


def test_run_gives_the_same_rows(spark, steps):
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(tuple(r) for r in steps[5].select("doc_id", "start", "length", "ids_crc32").collect())


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert importlib.util.find_spec("tidewater.llm") is not None
