"""Periodic runs and SimHash components against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

from tests.llm.fixtures import SCHEMA, edge_texts, frame, words
from tidewater.llm import periodic_runs, queries, simhash
from tidewater.llm.periodic_runs import find_runs, lag_scan, runs_in, with_digests
from tidewater.llm.simhash import fingerprint, links, masks, near_copies

TABLE = queries.queries()


def key(row):
    return tuple((x is None, x) for x in row)


def plain_runs(w):
    """Every lag against every place; of equal stretches the smallest lag stays."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        j = 0
        while j < len(w) - q:
            s = j
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - s + q >= max(6, 4 * q):
                found.setdefault((s, j - s + q), q)
            j += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def run_rows(rows, tail):
    out = []
    for i, t in rows:
        w = words(t)
        h, n = zlib.crc32(str(i).encode() if i is not None else b""), len(w)
        if tail and h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(w)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        text = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=key)


def test_runs_of_words():
    rng, found = random.Random(3), 0
    for _ in range(1500):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5])
        w = [rng.randrange(k) for _ in range(n)]
        if n > 8 and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want = plain_runs(w)
        found += len(want)
        assert runs_in(np.array(w, np.int64), np.zeros(n, np.int64)) == want
        assert sorted(lag_scan(np.array(w, np.int64)), key=lambda r: (r[0], r[2])) == want
    assert found > 500


def test_runs_stay_in_their_text_and_long_texts_end():
    w = np.zeros(12, np.int64)
    assert runs_in(w, np.repeat([0, 1], 6)) == [(0, 6, 1), (6, 6, 1)]
    assert runs_in(np.arange(2_000_000) % 2_500, np.zeros(2_000_000, np.int64)) == [(0, 2_000_000, 2_500)]
    # A word of three occurrences at a time makes the next one too rare: more rounds than the limit.
    chain = [x for i in range(300) for x in (i, i + 1, i, i + 1, i)] + [7] * 9
    assert runs_in(np.array(chain), np.zeros(len(chain), np.int64)) == plain_runs(chain)


@pytest.mark.parametrize("tail", [False, True])
def test_run_query_on_edge_cases(spark, tail):
    rows = edge_texts() + [(i, " ".join(f"w{k % 37}" for k in range(i))) for i in range(100, 260)] + [(7, None), (300, "x y " * 50 + "z " * 5)]
    got = with_digests(find_runs(frame(spark, rows).repartition(3), queries.repeated_tail if tail else None)).drop("n_words")
    assert sorted((tuple(r) for r in got.collect()), key=key) == run_rows(rows, tail)


def test_run_query_on_the_table(spark):
    rows = [tuple(r) for r in queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in TABLE["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()), key=key) == run_rows(rows, True)


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert find_runs(nothing).count() == 0 and near_copies(nothing).count() == 0


def test_a_text_beyond_one_pass(spark):
    long = " ".join(f"v{k % 90_001}" for k in range(900_000))
    row = find_runs(frame(spark, [(1, long), (2, "a b")])).filter("doc_id = 1").head()
    assert [tuple(r) for r in row["runs"]] == [(0, 900_000, 90_001)] and len(row["text"].split()) == 90_001


def print_of(text):
    w = [x.decode() for x in words(text, lower=True)]
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_rows(rows):
    prints = [print_of(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        least[x] = min((v for v in (least.get(x), i) if v is not None), default=None)
    return sorted(((i, f"{p:016x}", least[x]) for (i, _), p, x in zip(rows, prints, label)), key=key)


def test_fingerprint_of_long_texts():
    text = " ".join(f"w{k % 1_013}" for k in range(140_000))
    assert fingerprint(words(text)) == print_of(text)


@pytest.mark.parametrize("radius", [1, 3, 5])
@pytest.mark.parametrize("kept", [0, 0x00FF00FF00FF00FF, (1 << 58) - 1])
def test_masks_cover(radius, kept):
    rng, found = random.Random(radius), masks(kept, radius)
    free = [i for i in range(64) if not kept >> i & 1]
    assert len(found) <= 2 ** (radius + 1) - 1 and all(m & kept == kept and m != kept for m in found)
    for _ in range(3000):
        differing = sum(1 << i for i in rng.sample(free, min(radius, len(free) - 1)))
        assert any(m & differing == 0 for m in found)


def test_components_of_fingerprints(spark):
    rng = random.Random(9)
    rows = edge_texts() + [(2000, None), (None, "null ids " * 3), (None, "null ids " * 3)]
    base = [f"t{rng.randint(0, 90)}" for _ in range(150)]
    for i in range(60, 130):
        near = list(base)
        for _ in range(rng.randint(0, 6)):
            near[rng.randrange(len(near))] = f"n{rng.randint(0, 9)}"
        rows.append((i, " ".join(near)))
    got = near_copies(frame(spark, rows).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=key) == component_rows(rows)


def test_crowded_buckets_lose_no_link(spark):
    """Fingerprints that agree in most bits: buckets are covered again and again, and all links stay."""
    rng = random.Random(4)
    prints = {rng.getrandbits(12) << 20 | rng.getrandbits(3) << 60 for _ in range(900)} | {rng.getrandbits(64) for _ in range(300)}
    prints = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame_ = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {(r["a"], r["b"]) for r in links(frame_, most=8).collect()}

    def roots(edges):
        up = {p: p for p in prints}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
        return {p: root(p) for p in prints}

    values = np.array(prints, np.int64)
    near = np.argwhere(np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64)) <= 3)
    assert roots(found) == roots((prints[a], prints[b]) for a, b in near if a < b)


def test_components_of_the_table(spark):
    rows = [tuple(r) for r in queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in TABLE["op12_simhash"](spark, "/root/testdata/sf0.001").collect()), key=key) == component_rows(rows)


def test_splitting_rounds_change_nothing(monkeypatch):
    w = np.array([k % 9 for k in range(80)] + list(range(50)) + [3] * 7)
    want = runs_in(w, np.zeros(len(w), np.int64))
    monkeypatch.setattr(periodic_runs, "ROUNDS", 0)
    assert runs_in(w, np.zeros(len(w), np.int64)) == want and simhash.BUCKET == 256
