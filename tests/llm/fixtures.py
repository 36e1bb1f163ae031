"""Small documents with every awkward case, and plain Python forms of the contracts."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, n_words string, sequence_id string, `_key` string"
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, lower: bool = False) -> list[bytes]:
    text = text or ""
    return (text.translate(_UPPER) if lower else text).encode().split()


def edge_texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """(doc_id, text): nulls, empties, blanks only, long texts, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(seed)
    make = lambda n: [rng.choice("the of and zebra crossing über naïve 12 x. don't 日本 ,".split()) + str(rng.randint(0, 40)) for _ in range(n)]
    passage = make(70)
    base = make(200)
    out: list[tuple[int | None, str | None]] = [(0, None), (1, ""), (2, " \t\n \x0b"), (3, "one"), (4, "One two"), (None, "null id " + " ".join(passage)), (None, None)]
    for i in range(5, 25):
        own = make(rng.randint(1, 90))
        at = rng.randint(0, len(own))
        out.append((i, " ".join(own[:at] + passage[rng.randint(0, 15):] + own[at:])))
    for i in range(25, 45):
        near = list(base)
        for _ in range(rng.randint(0, 12)):
            near[rng.randrange(len(near))] = "edit" + str(rng.randint(0, 9))
        out.append((i, "\n".join(near) if i % 2 else " ".join(near)))
    out += [(45, " ".join(base)), (46, " ".join(base)), (46, " ".join(base)), (47, "a " * 6000), (48, "A b c d \U0001f389 é"), (48, "other text same id " + " ".join(passage))]
    out += [(49, " ".join(make(4000))), (50, "a " * 60), (51, "b " * 4), (52, "b " * 5), (53, "x" * 5000)]
    return out


def frame(spark, rows):
    full = [(i, t, "en" if i is None or i % 3 else "de", "s", len(t or ""), "own", "own", "own", "own", "own") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)
