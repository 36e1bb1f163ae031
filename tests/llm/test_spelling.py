"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.fixtures import SCHEMA, edge_texts, frame
from tidewater.llm.spelling import _number, _trie, drop_one_letter, group_variants, spelling_variants

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1 :]
        yield word[:i] + word[i + 1 :]


def variants(count):
    letters = set("".join(count))
    near = {w: {v for v in edits(w, letters) if v in count and v != w} for w in count}
    best = {w: min(near[w], key=lambda v: (-count[v], v), default=None) for w in count}
    form = {w: b if b is not None and count[b] >= 10 * count[w] else None for w, b in best.items()}
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w] or "", root, count[w], len(near[w]), count.get(form[w], -1)))
    return sorted(out)


def rows_of(found):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in found.collect())


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_neighbours_and_chains(spark, parts):
    rng = random.Random(parts)
    count = {"".join(rng.choice("abà") for _ in range(rng.randint(1, 8))): rng.choice([2, 3, 5, 50, 600, 7000, 90000]) for _ in range(1200)}
    count |= {"ss" * 40 + "t": 5, "ss" * 40: 50, "s" + "ss" * 40: 5, "x": 9}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert rows_of(group_variants(spark.createDataFrame(list(count.items()), "word string, n long"))) == variants(count)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nodes_are_the_prefixes(spark):
    """Equal numbers exactly for equal prefixes, also across slices, and every shared prefix has one."""
    words = sorted({"".join(random.Random(i).choices("ab", k=1 + i % 9)) for i in range(400)})
    seen = {}
    kept = 0
    for r in _trie(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, carried long")).collect():
        for depth, node in enumerate(r["nodes"]):
            kept += 1
            assert seen.setdefault(node, r["word"][:depth]) == r["word"][:depth]
    assert len(seen) == len(set(seen.values())) and kept > len(words)
    shared = {p for p, n in Counter(w[:d] for w in words for d in range(len(w) + 1)).items() if n > 1}
    assert shared <= set(seen.values())


def test_documents_with_every_awkward_case(spark):
    rng = random.Random(2)
    stems = ["Straßenbahn", "Économique", "kettledrum", "kettledrums", "Naïvetés", "ÀÁÂÃÄÅÆ", "×÷×÷×÷×", "sixletr", "mississippi", "w" * 3000]
    rows = edge_texts() + [(i, " ".join(rng.choices(stems, k=60)) + ",") for i in range(400, 600)] + [(None, "kettledrum " * 30), (401, "kettledrum-kettledrumm")]
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    want = variants(count)
    assert rows_of(spelling_variants(frame(spark, rows).repartition(3), drop_one_letter)) == want
    assert any(r[1] for r in want)


def test_empty_tables(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert list(_number(iter([]))) == []
