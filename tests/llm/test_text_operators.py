"""Substring dedup, byte BPE, token counts, packing, Jaccard join and language model against plain Python."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.fixtures import SCHEMA, edge_texts, frame, words
from tidewater.llm import byte_bpe, jaccard_join, lm_scoring, packing, substring_dedup, token_counts
from tidewater.llm.common import WordHashes
from tidewater.llm.components import components

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ROWS = edge_texts()


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def repeats(rows, n):
    last = math.inf
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - n + 1):
            key = tuple(w[p : p + n])
            first[key] = min(first.get(key, last), last if i is None else i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - n + 1):
            if first[tuple(w[p : p + n])] < (last if i is None else i):
                gone[p : p + n] = [True] * n
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_substring_dedup(docs, small_batches):
    got = [tuple(r) for r in substring_dedup.find_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    want = repeats(ROWS, 50)
    assert sorted(got, key=key) == sorted(want, key=key) and sum(r[2] for r in want) > 500


def test_removed_text(docs, nothing):
    got = substring_dedup.remove_repeats(docs)
    assert got.columns == docs.columns and substring_dedup.remove_repeats(nothing).count() == 0
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(r["score"] == "own" for r in rows)
    want = collections.Counter((i, h) for i, _, _, h in repeats(ROWS, 50))
    assert collections.Counter((r["doc_id"], hashlib.sha256(b" ".join(words(r["text"]))).hexdigest()) for r in rows) == want


@pytest.mark.parametrize("seed", range(40))
def test_equal_windows_have_equal_representatives(seed):
    rng = random.Random(seed)
    alphabet = [b"%d" % i for i in range(rng.choice([1, 2, 3, 8, 50]))]
    n = rng.choice([1, 2, 5, 8, 20, 50])
    base = [rng.choice(alphabet) for _ in range(120)]
    texts = []
    for _ in range(6):
        s = rng.randint(0, 60)
        texts.append([rng.choice(alphabet) for _ in range(rng.randint(0, 60))] + base[s : s + rng.randint(0, 60)] + [rng.choice(alphabet)] * rng.randint(0, 70))
    d, first, last, name = substring_dedup.anchors([WordHashes().of(w) for w in texts], n)
    at = {(x, p): y for x, a, b, y in zip(d, first, last, name) for p in range(a, b + 1)}
    seen = {}
    for i, w in enumerate(texts):
        for p in range(len(w) - n + 1):
            assert seen.setdefault(tuple(w[p : p + n]), at[i, p]) == at[i, p]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(docs, nothing, library):
    encoded = byte_bpe.encode_texts(docs, RANKS, PATTERN)
    want = collections.Counter((i, tuple(library.encode_ordinary(t or ""))) for i, t in ROWS)
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == want
    back = byte_bpe.decode_ids(encoded, RANKS, PATTERN).collect()
    assert collections.Counter((r["doc_id"], bytes(r["decoded"])) for r in back) == collections.Counter((i, (t or "").encode()) for i, t in ROWS)
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(nothing, RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_byte_bpe_on_odd_white_space(library):
    own = byte_bpe.codec(RANKS, PATTERN)
    rng = random.Random(3)
    parts = ["a", "é", " ", "  ", "\n", "\t", " ", "\x1c", "\x85", "'s", "12", "!?", "日", "<|endoftext|>", "́", "﻿"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_token_tree_follows_edits(library):
    own = byte_bpe.codec(RANKS, PATTERN)
    count = lambda leaves: [len(b) // 4 for b in own.encode_all(list(leaves))]
    rng = random.Random(5)
    parts = ["ab", "cd", " ", " ", "\n", "é", "12", ".", "  ", "'s"]
    for _ in range(120):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 40, 600])))
        tree = token_counts.CountTree(token_counts.cut_leaves(text, rng.choice([1, 4, 16, 256])), count)
        for _ in range(5):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.randint(0, 9))
            new = "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.total == len(library.encode_ordinary(text))


def test_token_counts(spark, docs, nothing, library):
    edit = token_counts.masking(r"\d+", "<n>")
    got = token_counts.count_edits(docs, edit, RANKS, PATTERN).collect()
    import re
    want = collections.Counter()
    for i, t in ROWS:
        t = t or ""
        new, n = re.subn(r"\d+", "<n>", t)
        want[i, len(library.encode_ordinary(t)), n, len(library.encode_ordinary(new))] += 1
    assert collections.Counter(tuple(r)[:4] for r in got) == want
    assert token_counts.count_edits(nothing, edit, RANKS, PATTERN).count() == 0
    given = spark.createDataFrame([(1, "hello big world", [(6, 9, "small"), (8, 10, "x"), (None, 1, "y"), (90, 99, "z")]), (2, None, None)],
                                  "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>")
    rows = {r["doc_id"]: r for r in token_counts.count_edits(given, "edits", RANKS, PATTERN).collect()}
    assert rows[1]["n_edits"] == 1 and rows[1]["n_tokens_after"] == len(library.encode_ordinary("hello small world")) and rows[2]["n_tokens"] == 0


def test_packing(docs, nothing):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack_documents(docs, WORD_BPE).collect()
    assert packing.pack_documents(nothing, WORD_BPE).count() == 0
    want = collections.Counter()
    for i, t in ROWS:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 2048):
            want[i, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()), len(ids)] += 1
    assert collections.Counter(tuple(r)[:5] for r in rows) == want
    for _, pieces in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for p in pieces:
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048


def test_word_ids_are_the_tokenizers():
    """Marks on all sides, contractions, special strings in either case, letters whose lower case changes length, odd blanks."""
    tokenizer = Tokenizer.from_file(WORD_BPE)
    texts = ["They'RE (said) \"it's\" dogs' -- 'tis!?...", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b X<|EndOfText|>", "\u0130STANBUL \u1e9e A\u030angstr\u00f6m \ufb01n",
             "a\u00a0b\u3000c\x1cd\x85e \u2028f", "x$$$ 12.5% \u0664\u0665 _a_ foo_bar $a$ \u00bdcup", None, "", " \t ", "caf\u00e9's \u65e5\u672c\u8a9e\u3002\u30c6\u30b9\u30c8", "Word " * 50 + "wORD,"]
    known = packing.WordIds(WORD_BPE, chunks=4, stems=4)
    for _ in range(3):  # known chunks, forgotten ones, and ones called back
        for some in (texts, texts[::-1], texts[:3]):
            got = [np.frombuffer(x, "<u4").tolist() for x in known.ids_of_all(some)]
            assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]
    for at in range(len(texts)):
        ids, bounds = known.flat_ids(pa.array(texts).slice(at, 3))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts[at : at + 3]]


def test_window_is_filled_as_far_as_can_be():
    rng = random.Random(1)
    for _ in range(200):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        capacity = rng.randint(1, 60)
        used = packing.fill_window(collections.Counter(lengths), capacity)
        best = max(s for m in range(1 << len(lengths)) if (s := sum(x for k, x in enumerate(lengths) if m >> k & 1)) <= capacity)
        assert sum(k * v for k, v in used.items()) == best and all(used[k] <= lengths.count(k) for k in used)


def linked(rows):
    """(doc_id, set size, smallest id) by comparing all sets."""
    sets = []
    for _, t in rows:
        w = words(t, lower=True)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), math.inf), math.inf if i is None else i)
    ids = [least[root(k)] for k in range(len(rows))]
    return [(i, len(s), None if c == math.inf else c) for (i, _), s, c in zip(rows, sets, ids)]


@pytest.mark.parametrize("chunk", [1024, 6])
def test_jaccard_join(docs, nothing, small_batches, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "HUBS", 1)
    got = [tuple(r) for r in jaccard_join.link_documents(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(linked(ROWS), key=key)
    if chunk == 1024:
        assert jaccard_join.link_documents(nothing).count() == 0
        kept = jaccard_join.keep_one(docs)
        assert kept.columns == docs.columns
        want = {(i, t) for (i, t), (_, _, c) in zip(ROWS, linked(ROWS)) if i == c}
        assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=key) == sorted(want, key=key)


def test_similar_sets_share_as_many_signatures_as_their_tag_says():
    rng = np.random.default_rng(2)
    for n in [1, 2, 3, 4, 5, 12, 16, 17, 48, 50, 64, 65, 70, 190, 200, 256, 257, 300, 760, 1000, 1100]:
        for _ in range(12):
            m = int(rng.integers(math.ceil(0.75 * n), n + 1))
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            both = rng.integers(math.ceil(3 * (n + m) / 7), m + 1) if math.ceil(3 * (n + m) / 7) <= m else None
            if both is None or len(a) < n:
                continue
            b = np.unique(np.concatenate([rng.permutation(a)[:both], rng.integers(0, 1 << 62, m - both).astype(np.uint64)]))
            if 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
                continue
            x, y = ({tag // 64: (tag % 64, set(s.tolist())) for tag, s in jaccard_join.signatures(e)} for e in (a, b))
            shared = max(len(x[k][1] & y[k][1]) - max(x[k][0], y[k][0]) for k in x.keys() & y.keys())
            assert shared >= 0 or any(len(x[k][1] & y[k][1]) >= min(x[k][0], y[k][0]) for k in x.keys() & y.keys())


def test_signatures_travel_packed_and_whole(spark):
    rng = np.random.default_rng(5)
    own = np.repeat(rng.integers(-(1 << 63), (1 << 63) - 1, 1_000), 200)
    sig, tag = rng.integers(0, 1 << 64, len(own), dtype=np.uint64), np.where(np.arange(len(own)) % 3, 4 * 64 + 16, 12 * 64 + 3).astype(np.int32)
    sig[1::10] = sig[rng.integers(0, len(sig), len(sig[1::10]))]  # some that several sets have
    sig[:200:40] = sig[200:400:40] = np.uint64(0), np.uint64(2**64 - 1), sig[7], sig[7], sig[7]
    for buckets in (1, 7, 500):
        rows = list(jaccard_join._packed(sig, own, tag, buckets))
        # Sent one by one, a signature takes 18 bytes once it is compressed.
        assert sum(len(plain) + len(dense) for _, _, plain, dense in rows) < 14 * len(sig)
        back = [np.concatenate(c) for c in zip(*(jaccard_join._unpacked(*row, buckets) for row in rows))]
        assert sorted(zip(*(c.tolist() for c in back))) == sorted(zip((sig >> np.uint64(16)).tolist(), own.tolist(), tag.tolist()))
    twice = [*jaccard_join._packed(sig, own, tag, 500), *jaccard_join._packed(sig[:900], own[:900], tag[:900], 500)]
    got = jaccard_join._met(spark.createDataFrame([(b, n, bytes(x), bytes(y)) for b, n, x, y in twice], "bucket int, rows int, plain binary, dense binary").repartition(3), 500).collect()
    sets = {}
    for s, o in zip((sig >> np.uint64(16)).tolist(), own.tolist()):
        sets.setdefault(s, set()).add(o)
    assert sorted((r["sig"], r["set"], r["often"], r["b"]) for r in got) == sorted((s, o, len(x), min(x)) for s, x in sets.items() if len(x) > 1 for o in x)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    parent = {v: v for e in edges for v in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked_nodes = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: root(v) for v in linked_nodes}


def test_language_model_base_and_code(docs, nothing):
    rows = lm_scoring.score_documents(docs).collect()
    counts = collections.Counter()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    for i, t in ROWS:
        if not held(i):
            counts.update([*words(t, lower=True), None])
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in ROWS:
        w = [*words(t, lower=True), None]
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        want.append((i, held(i), len(w), sum(counts[x] > 0 for x in w), total, round(base, 6)))
    got = [(*tuple(r)[:5], round(r["base_score"], 6)) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key) and all(r["score"] < 0 for r in rows)
    assert lm_scoring.score_documents(nothing).count() == 0


def test_context_trees_mix_as_the_definition_says(spark):
    """Weights and mixture against a recursive form, on a tiny corpus."""
    depth, text = 2, b"abracadabra\nabrac\n"
    seq = lm_scoring.sequences([text], depth)
    counted = spark.createDataFrame([(int(k), int(n)) for k, n in collections.Counter(seq.tolist()).items()], "key long, n long")
    levels = lm_scoring.tree_levels(counted, depth)
    nodes = []
    for level in levels:
        rows = level.collect()
        nodes.append((np.array([(r["context"] << 8) + r["node"] for r in rows]), np.array([(r["n1"] + 0.5) / (r["n0"] + r["n1"] + 1) for r in rows]), np.array([r["stop"] for r in rows])))
    trees = lm_scoring.ContextTrees(nodes)
    seen = collections.defaultdict(lambda: [0, 0])
    for s in seq.tolist():
        byte = s & 255
        for d in range(depth + 1):
            for j in range(8):
                seen[d, (s >> 8) & ((1 << 8 * d) - 1), (1 << j) | (byte >> (8 - j))][(byte >> (7 - j)) & 1] += 1

    def kt(c):
        return math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.lgamma(sum(c) + 1) - math.log(math.pi)

    def pw(d, context, node):
        own = kt(seen[d, context, node])
        if d == depth:
            return own
        below = sum(pw(d + 1, c, node) for (e, c, n) in list(seen) if e == d + 1 and n == node and c & ((1 << 8 * d) - 1) == context)
        return math.log(0.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))

    def predict(d, context, node):
        c = seen[d, context & ((1 << 8 * d) - 1), node]
        p = (c[1] + 0.5) / (sum(c) + 1)
        deeper = (d + 1, context & ((1 << 8 * (d + 1)) - 1), node)
        if d == depth or deeper not in seen:
            return p
        stop = math.exp(math.log(0.5) + kt(c) - pw(d, context & ((1 << 8 * d) - 1), node))
        return stop * p + (1 - stop) * predict(d + 1, context, node)

    probe = np.unique(np.append(seq, [ord("z"), (ord("a") << 8) + ord("q")]))
    for s, got in zip(probe.tolist(), trees.log_probability(probe)):
        total, byte = 0.0, s & 255
        for j in range(8):
            node, bit = (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1
            p = predict(0, s >> 8, node) if (0, 0, node) in seen else 0.5
            total += math.log(p if bit else 1 - p)
        assert got == pytest.approx(total, abs=1e-9)


@pytest.mark.parametrize("common", [lm_scoring.COMMON, 300])
def test_language_model_uses_every_node(spark, monkeypatch, common):
    """On a corpus where a share of the bytes would cut nodes, the scores are those of the whole trees, known to tasks or joined."""
    monkeypatch.setattr(lm_scoring, "COMMON", common)
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijkl" if rng.random() < 0.02 else "abc", k=rng.randint(2, 8)))
    rows = [(i, " ".join(word() for _ in range(260))) for i in range(850)]
    rows += [(2000, "zebra quiz \u65e5\u672c"), (2001, None), (None, "null id"), (7, rows[7][1])]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    streams = [lm_scoring.stream(words(t, lower=True)) for _, t in rows]
    keys, n = np.unique(lm_scoring.sequences([s for (i, _), s in zip(rows, streams) if not held(i)]), return_counts=True)
    assert n.sum() * 2.0**-19 > 2
    levels = lm_scoring.tree_levels(spark.createDataFrame(list(zip(keys.tolist(), n.tolist())), "key long, n long").repartition(4))
    nodes = []
    for level in levels:
        t = level.selectExpr("(context << 8) + node as key", "(n1 + 0.5D) / (n0 + n1 + 1) as one", "stop").toArrow()
        nodes.append(tuple(t[c].to_numpy() for c in ("key", "one", "stop")))
    trees = lm_scoring.ContextTrees(nodes)
    want = []
    for (i, _), s in zip(rows, streams):
        ln = trees.log_probability(lm_scoring.sequences([s]))
        want.append((i, round(float(ln.sum()) / math.log(10), 5)))
    got = [(r["doc_id"], round(r["score"], 5)) for r in lm_scoring.score_documents(frame(spark, rows).repartition(3)).collect()]
    assert [k[0] for k in sorted(got, key=key)] == [k[0] for k in sorted(want, key=key)]
    assert all(a[1] == pytest.approx(b[1], abs=3e-5) for a, b in zip(sorted(got, key=key), sorted(want, key=key)))
