"""Toxicity by a bidirectional gated recurrent network with attention pooling over word and character inputs.

A word enters as its own vector, which begins with the word's smoothed log-odds, beside the mean vector
of its character trigrams. A long word enters as overlapping pieces, each like a word. The network reads windows of words that overlap by half; a document's score is that of its worst window. Training and
scoring are numpy: the driver fits on a bounded sample of labelled rows, tasks score whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import slices, words_of

WINDOW, STRIDE = 32, 16
HIDDEN, WIDTH = 8, 8
TRIGRAMS, PER_WORD = 4096, 16
#: Labelled rows that the driver fits on, at most, by label; and the words that have a vector of their own.
FIT_TOXIC, FIT_CLEAN, VOCABULARY = 1_000, 3_000, 20_000
#: Bytes of the longest text that is learnt from; texts of any length are scored whole.
FIT_BYTES = 32_768
#: Windows that go through the network together, and words whose inputs a task remembers.
BLOCK, CACHE = 2_048, 150_000
#: Share of word vectors left out in training.
DROPPED = 0.3
#: Weight decay of the word and trigram vectors.
DECAY = 0.1
_EDGE = b".,;:!?\"'()[]{}*#$%&|<>-_~"


def pieces(word: bytes) -> list[bytes]:
    """The UTF-8 word, or if it has more trigrams than one input holds, pieces cut between characters.

    Neighbours share at least two bytes, so every trigram of the word lies in a piece.
    """
    out, start = [], 0
    while len(word) - start > PER_WORD:
        end = start + PER_WORD
        while word[end] & 0xC0 == 0x80:
            end -= 1
        out.append(word[start:end])
        start = end - 2
        while word[start] & 0xC0 == 0x80:
            start -= 1
    return [*out, word[start:]]


def plain(words: list[bytes]) -> list[bytes]:
    """Words without marks at their ends, long ones in pieces; a word of marks alone keeps them."""
    bare = [w.strip(_EDGE) or w for w in words]
    if all(len(w) <= PER_WORD for w in bare):
        return bare
    return [p for w in bare for p in pieces(w)]


def trigrams(word: bytes) -> list[int]:
    """Buckets of the trigrams of a word or piece of at most PER_WORD bytes, its borders included."""
    if len(word) > PER_WORD:
        raise ValueError(f"{len(word)} bytes have to be cut into pieces first")
    marked = b"^" + word + b"$"
    found = [zlib.crc32(marked[i : i + 3]) % (TRIGRAMS - 1) + 1 for i in range(max(1, len(marked) - 2))]
    return (found + [0] * PER_WORD)[:PER_WORD]


def window_starts(n: int) -> range:
    """Starts of all overlapping windows of n words; an empty text has one empty window."""
    return range(0, max(1, n - STRIDE), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights: word and trigram vectors, per direction gate weights (input, state, bias; gates z, r, n), attention, output."""

    vocabulary: dict[bytes, int]
    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, vocabulary: dict[bytes, int], rng) -> Network:
        d, h = 2 * WIDTH, HIDDEN
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        p = {"word": normal(len(vocabulary) + 1, WIDTH, scale=0.1), "tri": normal(TRIGRAMS, WIDTH, scale=0.1)}
        p["word"][0] = p["tri"][0] = 0
        for side in "fb":
            p |= {f"W{side}": normal(d, 3 * h, scale=d**-0.5), f"U{side}": normal(h, 3 * h, scale=h**-0.5), f"b{side}": np.zeros(3 * h, np.float32)}
        p |= {"att": normal(2 * h, scale=0.3), "out": normal(2 * h, scale=0.3), "bias": np.zeros(1, np.float32)}
        return cls(vocabulary, p)

    def inputs(self, ids: np.ndarray, tri: np.ndarray, odds: np.ndarray | None = None) -> np.ndarray:
        """(rows, 2 WIDTH) of words given as vocabulary ids (0: unknown) and trigram buckets (0: none)."""
        n = np.maximum((tri > 0).sum(-1, keepdims=True), 1).astype(np.float32)
        word = self.p["word"][ids]
        if odds is not None:
            word[..., 0] = odds
        return np.concatenate([word, self.p["tri"][tri].sum(-2) / n], -1)

    def forward(self, gates: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False):
        """Logits of windows; `gates` holds per direction the gate inputs (rows, WINDOW, 3 HIDDEN)."""
        rows, steps = mask.shape
        h, p = HIDDEN, self.p
        states = np.zeros((rows, steps, 2 * h), np.float32)
        saved = []
        for s, side in enumerate("fb"):
            state, u = np.zeros((rows, h), np.float32), p[f"U{side}"]
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                x, hu = gates[side][:, t], state @ u
                zr = _sigmoid(x[:, : 2 * h] + hu[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                n = np.tanh(x[:, 2 * h :] + r * hu[:, 2 * h :])
                m = mask[:, t, None]
                new = state + m * (1 - z) * (n - state)
                if keep:
                    saved.append((side, t, state, z, r, n, hu[:, 2 * h :], m))
                state = new
                states[:, t, s * h : (s + 1) * h] = state
        e = np.where(mask > 0, states @ p["att"], -1e9)
        a = np.exp(e - e.max(1, keepdims=True)) * mask
        a /= np.maximum(a.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,bth->bh", a, states)
        logit = pooled @ p["out"] + p["bias"][0]
        return (logit, states, a, pooled, saved) if keep else logit

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {side: x @ self.p[f"W{side}"] + self.p[f"b{side}"] for side in "fb"}

    def gradients(self, ids: np.ndarray, tri: np.ndarray, odds: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted cross entropy of windows: ids (rows, WINDOW), tri (rows, WINDOW, PER_WORD)."""
        p, h = self.p, HIDDEN
        x = self.inputs(ids, tri, odds)
        logit, states, a, pooled, saved = self.forward(self.gates(x), mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = ((_sigmoid(logit) - y) * weight).astype(np.float32) / len(y)
        g["bias"][0], g["out"] = d.sum(), pooled.T @ d
        d_pooled = d[:, None] * p["out"]
        d_a = np.einsum("bh,bth->bt", d_pooled, states)
        d_e = a * (d_a - (a * d_a).sum(1, keepdims=True))
        g["att"] = np.einsum("bt,bth->h", d_e, states)
        d_states = a[:, :, None] * d_pooled[:, None] + d_e[:, :, None] * p["att"]
        d_gates = {side: np.zeros((*mask.shape, 3 * h), np.float32) for side in "fb"}
        carried = {side: np.zeros((len(y), h), np.float32) for side in "fb"}
        for side, t, state, z, r, n, hn, m in reversed(saved):
            s = "fb".index(side)
            dh = carried[side] + d_states[:, t, s * h : (s + 1) * h]
            dn = dh * m * (1 - z) * (1 - n * n)
            dz = dh * m * (state - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            d_gates[side][:, t] = np.concatenate([dz, dr, dn], 1)
            du = np.concatenate([dz, dr, dn * r], 1)
            g[f"U{side}"] += state.T @ du
            carried[side] = dh * (1 - m * (1 - z)) + du @ p[f"U{side}"].T
        d_x = np.zeros_like(x)
        for side in "fb":
            flat = d_gates[side].reshape(-1, 3 * h)
            g[f"W{side}"], g[f"b{side}"] = x.reshape(-1, x.shape[-1]).T @ flat, flat.sum(0)
            d_x += d_gates[side] @ p[f"W{side}"].T
        np.add.at(g["word"], ids, d_x[..., :WIDTH])
        some = tri > 0
        shared = d_x[..., None, WIDTH:] / np.maximum(some.sum(-1), 1)[..., None, None]
        np.add.at(g["tri"], tri[some], np.broadcast_to(shared, (*tri.shape, WIDTH))[some])
        g["word"][0] = g["tri"][0] = 0
        g["word"][:, 0] = 0
        return g


class Windows:
    """Windows of texts as rows of word types, each type with its vocabulary id and trigrams; `texts` are read one by one."""

    def __init__(self, texts: Iterable[list[bytes]], vocabulary: dict[bytes, int] | None = None):
        types: dict[bytes, int] = {b"": 0}
        self.texts = [np.fromiter((types.setdefault(w, len(types)) for w in ws), np.int32, len(ws)) for ws in texts]
        self.types = list(types)
        counts = [len(window_starts(len(seq))) for seq in self.texts]
        self.doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.rows = np.zeros((len(self.doc), WINDOW), np.int32)
        at = 0
        for seq in self.texts:
            for s in window_starts(len(seq)):
                own = seq[s : s + WINDOW]
                self.rows[at, : len(own)] = own
                at += 1
        self.tri = np.zeros((len(types), PER_WORD), np.uint16)
        for i, w in enumerate(self.types):
            if w:
                self.tri[i] = trigrams(w)
        self.name(vocabulary or {})

    def name(self, vocabulary: dict[bytes, int]) -> None:
        self.ids = np.array([vocabulary.get(w, 0) for w in self.types], np.int32)


def fit(texts: Iterable[list[bytes]], toxic: list[int], seed: int = 11, rounds: int = 5, epochs: int = 4, rate: float = 0.01) -> Network:
    """Multiple-instance training: of each text the window that looks worst stands for it, chosen anew each round.

    Words lose their own vector at random, so that the trigrams have to carry the rest.
    Before the first round the choice falls to the word log-odds.

    Clean texts give a second, random window. Without both labels the network stays as it starts.
    """
    rng = np.random.default_rng(seed)
    y = np.array(toxic, np.float32)
    fold = np.arange(len(y)) % 2
    all_ = Windows(texts)
    seen = np.zeros((2, 2, len(all_.types)), np.int32)  # documents with a word, by fold and label
    for seq, label, f in zip(all_.texts, toxic, fold):
        seen[f, int(label), np.unique(seq)] += 1
    all_.texts = []
    total = seen.sum((0, 1))
    often = sorted(np.flatnonzero(total >= 4).tolist(), key=lambda i: (-total[i], all_.types[i]))[:VOCABULARY]
    vocabulary = {all_.types[i]: k + 1 for k, i in enumerate(often)}
    all_.name(vocabulary)
    net = Network.fresh(vocabulary, rng)
    if not 0 < y.sum() < len(y):
        return net
    share = float(y.mean())

    def lift(folds: list[int]) -> np.ndarray:
        """Smoothed log-odds of the vocabulary, from the documents of some folds."""
        own = seen[folds][:, :, often].sum(0)
        return np.concatenate([[0], np.log((own[1] + 2 * share) / (own.sum(0) + 2)) - np.log(share)]).astype(np.float32)

    # In training a text's words have the log-odds of the other half's texts, so that chance isn't learnt as certainty.
    crossed = np.stack([lift([1]), lift([0])])
    net.p["word"][:, 0] = lift([0, 1])
    half = fold[all_.doc]
    worst = np.concatenate([crossed[half[i : i + BLOCK, None], all_.ids[all_.rows[i : i + BLOCK]]].max(1) for i in range(0, len(half), BLOCK)])
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for r in range(rounds):
        order = np.lexsort((rng.random(len(worst)), worst))
        top = np.zeros(len(y), int)
        top[all_.doc[order]] = order
        other = np.flatnonzero(y[all_.doc] == 0)
        picked = np.concatenate([top, rng.choice(other, min(len(other), len(y)), replace=False)])
        labels = y[all_.doc[picked]]
        # Half-way between the classes as they come and classes of equal weight: clean texts are to be left alone.
        weight = np.sqrt(np.where(labels > 0, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))).astype(np.float32)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(picked)), min(len(picked), max(20, min(40, len(picked) // 96)))):
                rows = all_.rows[picked[part]]
                known = all_.ids[rows] * (rng.random(rows.shape) >= DROPPED)
                odds = crossed[half[picked[part]][:, None], known]
                g = net.gradients(known, all_.tri[rows], odds, (rows > 0).astype(np.float32), labels[part], weight[part])
                step += 1
                for k, value in g.items():
                    m, v = moment[k]
                    m += 0.1 * (value - m)
                    v += 0.001 * (value * value - v)
                    if k in ("word", "tri"):
                        net.p[k][:, k == "word" :] *= 1 - DECAY * rate
                    net.p[k] -= rate / (1 + r) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
        # Toxic texts keep the windows that the log-odds chose until the network can tell better.
        logits = score_windows(net, all_)
        worst = np.where((y[all_.doc] > 0) & (r < rounds // 2), worst, logits)
    return net


def score_windows(net: Network, windows: Windows) -> np.ndarray:
    """Logits of all windows; types and windows go through in blocks, so that only gate inputs are held for all types."""
    gates = {side: np.zeros((len(windows.ids), 3 * HIDDEN), np.float32) for side in "fb"}
    for at in range(0, len(windows.ids), BLOCK):
        own = slice(at, at + BLOCK)
        for side, v in net.gates(net.inputs(windows.ids[own], windows.tri[own])).items():
            gates[side][own] = v
    return np.concatenate([
        net.forward({s: v[rows] for s, v in gates.items()}, (rows > 0).astype(np.float32))
        for rows in np.array_split(windows.rows, max(1, -(-len(windows.rows) // BLOCK)))
    ])


class Scorer:
    """Scores texts with a fitted network; the gate inputs of words are computed once and remembered."""

    def __init__(self, net: Network):
        self.net = net
        self._clear()

    def _clear(self) -> None:
        self.row: dict[bytes, int] = {b"": 0}
        self.table = np.zeros((1 << 14, 6 * HIDDEN), np.float32)

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.row]
        if len(self.row) + len(new) > CACHE and len(self.row) > 1:
            self._clear()
            new = list(words - {b""})
        if not new:
            return
        first, last = len(self.row), len(self.row) + len(new)
        while last > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            gates = self.net.gates(self.net.inputs(
                np.array([self.net.vocabulary.get(w, 0) for w in some]), np.array([trigrams(w) for w in some])))
            self.table[first + at : first + at + len(some)] = np.concatenate([gates["f"], gates["b"]], 1)
        self.row.update(zip(new, range(first, last)))

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """The worst window's probability, per text."""
        self._learn(set().union(*texts) if texts else set())
        counts = np.array([len(window_starts(len(ws))) for ws in texts], np.int64)
        seq = np.fromiter((self.row[w] for ws in texts for w in ws), np.int64, sum(map(len, texts)))
        seq = np.concatenate([seq, np.zeros(WINDOW, np.int64)])
        ends = np.cumsum([0, *map(len, texts)])
        doc = np.repeat(np.arange(len(texts)), counts)
        start = ends[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
        length = np.minimum(ends[doc + 1] - start, WINDOW)
        logits, h = np.zeros(len(doc), np.float32), 3 * HIDDEN
        for at in range(0, len(doc), BLOCK):
            own = slice(at, at + BLOCK)
            mask = np.arange(WINDOW) < length[own, None]
            rows = np.where(mask, seq[np.minimum(start[own, None] + np.arange(WINDOW), len(seq) - 1)], 0)
            gates = self.table[rows]
            logits[own] = self.net.forward({"f": gates[..., :h], "b": gates[..., h:]}, mask.astype(np.float32))
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, doc, logits)
        return _sigmoid(worst)


def fitting_rows(docs: DataFrame, labels: DataFrame, usable: Column, toxic: int, clean: int, most_bytes: int = FIT_BYTES) -> list[tuple[str, int]]:
    """At most `toxic` and `clean` labelled texts, chosen by a hash of the id; of several labels of a document the highest counts.

    Of several texts of one id the one with the smallest hash is taken, before anything reaches the driver. Texts of
    more than `most_bytes` bytes aren't learnt from, so the sample is bounded in bytes as well.
    """
    truth = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    rows = []
    for label, most in ((1, toxic), (0, clean)):
        chosen = truth.filter(F.col("_toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        own = docs.select("doc_id", "text").filter(F.octet_length("text") <= most_bytes).join(F.broadcast(chosen), "doc_id")
        found = own.groupBy("doc_id", "_toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).toArrow()
        rows += zip(found["doc_id"].to_pylist(), found["text"].to_pylist(), found["_toxic"].to_pylist())
    return [(text, label) for _, text, label in sorted(rows, key=lambda r: r[0])]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, usable: Column, threshold: float = 0.7, toxic: int = FIT_TOXIC, clean: int = FIT_CLEAN
) -> DataFrame:
    """`docs` with score and predicted (columns of these names are replaced); `usable` selects the label rows that may be learnt from.

    Only the text enters a score. Null and empty texts get the score of an empty window. Repeated rows
    stay repeated and score alike. Without usable labels the scores come from an untrained network.
    """
    spark = docs.sparkSession
    docs = docs.drop("score", "predicted")
    sample = fitting_rows(docs, labels, usable, toxic, clean)
    net = spark.sparkContext.broadcast(fit((plain(words_of(t, lower=True)) for t, _ in sample), [y for _, y in sample]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net.value)
        for part in slices(batches):
            texts = part.column(part.schema.get_field_index("text")).to_pylist()
            found = scorer.score([plain(words_of(t, lower=True)) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32))],
                names=[*part.schema.names, "score", "predicted"])

    kind = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, kind)
