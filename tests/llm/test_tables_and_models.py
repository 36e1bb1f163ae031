"""URL filters, quality rules, nearest neighbours and toxicity: contracts, edges and held-out accuracy."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import SCHEMA, edge_texts, frame, words
from tidewater.llm import nearest, quality_rules, toxicity, url_filters
from tidewater.llm.common import words_of
from tidewater.llm.queries import URL_RULES


def judged(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for action, rule in rules:
        rh, _, rp = rule.partition("/")
        rp = "/" + rp if "/" in rule else ""
        if rh and (host == rh or host.endswith("." + rh)) and path.startswith(rp):
            rank = (len(rh) + len(rp), len(rh), action == "block")
            best = max(best, (rank, rule, action)) if best else (rank, rule, action)
    return host, path, best[1] if best else None, best[2] if best else default


URLS = [None, "", "no scheme", "http://", "://x.org/", "https://Example.ORG/es/1", "https://example.org/en/12?q=/es/", "http://a.b.example.org/en/1#x",
        "http://org/", "http://org", "http://myexample.org/es/", "ftp://x.com/fr/a://b.com/de/", "http://x.com/de/", "http://x.com/DE/", "http://é.com/fr/ü",
        "http://x.com:80/fr/", "http://.com/fr/", "http://a..com/fr/", "http://x.com?/fr/", "http://x.com/fr/" + "p" * 3000] * 2


def test_url_filters(spark):
    pages = spark.createDataFrame([(i, u, "own", "own", "own") for i, u in enumerate(URLS)], "page_id long, url string, host string, best string, short string")
    rules = [*URL_RULES, ("block", "example.org/es/"), ("allow", None), ("block", ""), ("block", "b.example.org"), ("allow", "x.com:80/")]
    table = spark.createDataFrame(rules, "action string, rule string")
    got = url_filters.filter_urls(pages, table)
    assert got.columns == ["page_id", "url", "best", "short", "host", "path", "rule", "verdict"]
    rows = {r["page_id"]: r for r in got.collect()}
    clean = [(a, r) for a, r in rules if r]
    for i, u in enumerate(URLS):
        r = rows[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(u, clean) and r["best"] == "own", u
    assert url_filters.filter_urls(pages.limit(0), table).count() == 0
    assert {r["verdict"] for r in url_filters.filter_urls(pages, table.limit(0), default="block").collect()} == {"block"}


def measured(text):
    text = text or ""
    w = words(text)
    tri = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {p for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if line.translate(dict.fromkeys(map(ord, " \t\x0b\x0c\r")))]
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    rows = edge_texts() + [(60, "a#b $$ |\n \nx y\nx y\n\x0bx y"), (61, "\U0001f389 é\x1c\x85 z"), (62, "p q r p q r p q"), (63, "to be to be to be")]
    labels = spark.createDataFrame([(3, 1, "x"), (3, 0, "x"), (None, 1, "x"), (4, None, "x")], "doc_id long, quality int, lang string")
    got = quality_rules.judge(frame(spark, rows), labels)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = collections.Counter()
    for i, t in rows:
        m = measured(t)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        want[(i, *m, failed, not failed)] += 1
    out = got.collect()
    assert collections.Counter((r["doc_id"], *(r[n] for n in names), r["base_failed"], r["kept"]) for r in out) == want
    assert all(r["score"] == "own" and r["_key"] == "own" for r in out)
    assert quality_rules.judge(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_cutoffs_keep_their_promise(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(3000):
        good = rng.random() < 0.8
        share = rng.uniform(0, 0.3) if good else rng.uniform(0.2, 1.2)
        n = 100
        rows.append((i, " ".join(f"w{i}x{k}" + ("#" if k < share * n else "") for k in range(n)), "en" if i % 2 else "de"))
        labels.append((i, int(good)))
    docs = quality_rules.measures(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = quality_rules.cutoffs(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert {(r["stratum"], r["rule"]) for r in found} == {("en", "symbols_per_word"), ("de", "symbols_per_word")}
    assert all(0.25 < r["cutoff"] <= 0.5 for r in found)
    few = quality_rules.cutoffs(docs.filter("doc_id < 100"), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert few.count() == 0  # too few labels to certify anything


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (200, 3, 0.05), (1000, 10, 0.01), (50000, 400, 0.01)])
def test_binomial_tail(spark, n, k, p):
    tail = spark.range(1).select(quality_rules.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), F.lit(p)).alias("t")).head()["t"]
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    assert tail == pytest.approx(math.fsum(map(math.exp, log)), rel=1e-8)


def test_nearest(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[7][1]) for i in range(1500)]  # a third has one vector
    bad = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [None] * 16), (9004, [1.0] * 3), (9005, []), (9006, [float("inf")] * 16), (None, rows[0][1])]
    table = spark.createDataFrame([(*r, "own") for r in [*rows, *bad, rows[5], rows[5]]], "vec_id long, embedding array<float>, vector string")
    got = collections.defaultdict(list)
    for r in nearest.nearest(table, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    hits = 0
    assert set(got) == {int(i) for i in ids if i % 50 == 0}
    for q, found in got.items():
        far = np.sqrt(((m - m[ids == q][0]) ** 2).sum(1))
        order = [int(i) for i in np.lexsort((ids, far)) if ids[i] != q][:10]
        want = [(int(ids[i]), far[i]) for i in order]
        hits += len({a for a, _ in found} & {a for a, _ in want})
        assert all(s == pytest.approx(far[ids == v][0], rel=1e-12) for v, s in found) and found == sorted(found, key=lambda x: (x[1], x[0]))
    assert hits >= 0.95 * 10 * len(got)
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nearest.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1, 0.0), (0, 2, 2, 1.0)]
    assert nearest.nearest(few.limit(0), F.col("vec_id") == 0).count() == 0


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(5)
    net = toxicity.Network.fresh({b"a": 1, b"b": 2, b"c": 3}, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    windows = toxicity.Windows([[b"a", b"b", b"zz"], [b"c"] * 40, []], net.vocabulary)
    rows = windows.rows
    mask, y, weight = (rows > 0).astype(float), np.array([1.0, 0.0, 1.0, 0.0])[: len(rows)], np.ones(len(rows))
    ids, tri = windows.ids[rows], windows.tri[rows]

    def loss():
        x = net.inputs(ids, tri, net.p["word"][ids][..., 0])
        logit = net.forward({k: v.astype(np.float64) for k, v in net.gates(x).items()}, mask)
        return float((np.logaddexp(0, logit) - y * logit).mean())

    grads = net.gradients(ids, tri, net.p["word"][ids][..., 0], mask, y, weight)
    for name in ("Wf", "Ub", "bf", "att", "out", "bias", "word", "tri"):
        flat, g = net.p[name].reshape(-1), grads[name].reshape(-1)
        best = np.argsort(-np.abs(g))[:4]
        for i in best:
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert g[i] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=2e-5), name


def test_toxicity(spark):
    rng = random.Random(9)
    make = lambda n: [rng.choice(["calm", "tree", "river", "stone", "over", "light"]) + str(rng.randint(0, 99)) for _ in range(n)]
    rows, labels = [], []
    for i in range(600):
        w, bad = make(rng.randint(5, 150)), i % 4 == 0
        if bad:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(["Rotten!", "vile,", "ROTTEN", "vile"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    truth = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int")
    docs = frame(spark, rows + [(900, None), (901, ""), (0, rows[0][1])])
    got = toxicity.score_toxicity(docs, truth, F.col("doc_id") % 3 != 1)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]
    out = got.collect()
    held = [(r["predicted"], int(r["doc_id"] % 4 == 0)) for r in out if r["doc_id"] < 900 and r["doc_id"] % 3 == 1]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out) and len(out) == 603
    assert {r["predicted"] for r in out if r["doc_id"] >= 900} == {0}
    assert toxicity.score_toxicity(docs, truth.limit(0), F.lit(True)).count() == 603
    assert toxicity.score_toxicity(docs.limit(0), truth, F.lit(True)).count() == 0


def test_scores_are_those_of_the_worst_window():
    """Each window alone, with its inputs made word by word, against the scorer's tables and blocks."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [[rng.choice(vocabulary).encode() for _ in range(n)] for n in (0, 1, 15, 16, 17, 32, 33, 48, 49, 200)]
    net = toxicity.fit(texts * 3, [i % 2 for i in range(len(texts) * 3)], rounds=1, epochs=1)

    def alone(words):
        ids = np.array([[net.vocabulary.get(w, 0) for w in words] + [0] * (32 - len(words))])
        tri = np.array([[toxicity.trigrams(w) for w in words] + [[0] * toxicity.PER_WORD] * (32 - len(words))])
        mask = np.array([[1.0] * len(words) + [0.0] * (32 - len(words))])
        return 1 / (1 + np.exp(-float(net.forward(net.gates(net.inputs(ids, tri)), mask)[0])))

    want = [max(alone(t[i : i + 32]) for i in range(0, max(1, len(t) - 16), 16)) for t in texts]
    assert toxicity.Scorer(net).score(texts) == pytest.approx(want, abs=1e-5)


def test_fitting_sample_is_bounded_in_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "one"), (2, "one"), (3, None)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    found = toxicity.fitting_rows(docs, labels, F.lit(True), 10, 10)
    assert len(found) == 2 and found[0][1] == 1 and found[1] == ("one", 0)
    assert toxicity.fitting_rows(docs.repartition(2), labels, F.lit(True), 10, 10) == found
    assert toxicity.fitting_rows(docs, labels, F.lit(True), 10, 10, most_bytes=3) == [("one", 0)]


def test_every_byte_of_a_long_word_counts():
    net = toxicity.fit([[b"vile", b"calm"], [b"calm"]] * 8, [1, 0] * 8)
    rng = random.Random(4)
    for word in ["x" * 17, "a-b/" * 300, "\u4f60\u597d\u4e16\u754c" * 50, "n\u00efve_\U0001f389" * 20, "d\u00e9\u65e5" * 7, "y" * 16]:
        raw = word.encode()
        parts = toxicity.plain([raw])
        found = {p[i : i + 3] for p in parts for i in range(len(p) - 2)}
        assert found >= {raw[i : i + 3] for i in range(len(raw) - 2)} and all(p.decode() and len(p) <= toxicity.PER_WORD for p in parts)
        assert all(np.count_nonzero(toxicity.trigrams(p)) == len(p) for p in parts)
    start = "\u4f60\u597d\u4e16\u754c\u4f60\u597d\u4e16\u754c".encode()
    texts = [toxicity.plain([start + "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(9)).encode()]) for _ in range(5)]
    assert len(set(toxicity.Scorer(net).score(texts).tolist())) == 5


def test_words_of_splits_at_six_characters_only():
    assert words_of("a\x1cb\x85c\u00a0d e\tf\x0bg", lower=True) == ["a\x1cb\x85c\u00a0d".encode(), b"e", b"f", b"g"]
    assert words_of("ÀB", lower=True) == ["Àb".encode()]
