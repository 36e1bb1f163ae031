"""Edit-aware token counts: per document a segment tree over pre-tokens, of which only touched parts are re-encoded.

A leaf of the tree covers a run of text between safe borders and holds its tokens; an inner node
holds the sum of its children. A border is safe where white space doesn't meet white space and a
blank stands between two other characters: there every pre-token ends, whatever stands around. An edit
replaces the leaves that it touches, with one leaf of context on either side because an edit can take
a border away, and only sums above them change.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.byte_bpe import codec
from tidewater.llm.common import arrow_rows, parts

#: Characters of a leaf, about; leaves end at the first safe border behind.
LEAF = 256
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def cut_leaves(text: str, leaf: int = LEAF) -> list[str]:
    """The text in runs that end at safe borders (a run begins with the border's blank)."""
    out, start = [], 0
    while len(text) - start > leaf:
        border = _SAFE.search(text, start + leaf)
        if border is None:
            break
        out.append(text[start : border.start()])
        start = border.start()
    return [*out, text[start:]] if start < len(text) else out


class CountTree:
    """Sums of tokens and characters over the leaves of one document, as a balanced binary tree in arrays."""

    def __init__(self, leaves: Sequence[str], count: Callable[[Sequence[str]], list[int]], tokens: list[int] | None = None):
        self.count, self.encoded = count, 0
        self._build(list(leaves), count(leaves) if tokens is None else tokens)

    def _counted(self, leaves: Sequence[str]) -> list[int]:
        self.encoded += sum(map(len, leaves))
        return self.count(leaves)

    def _build(self, leaves: list[str], tokens: list[int]) -> None:
        self.leaves, self.size = leaves, 1
        while self.size < len(leaves):
            self.size *= 2
        self.tokens, self.chars = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (leaf, n) in enumerate(zip(leaves, tokens)):
            self.tokens[self.size + i], self.chars[self.size + i] = n, len(leaf)
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, node: int) -> None:
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its start) of the leaf that holds character `place`; the last leaf at the text's end."""
        node, start = 1, 0
        while node < self.size:
            left = self.chars[2 * node]
            node = 2 * node if place < start + left else 2 * node + 1
            start += left if node & 1 else 0
        leaf = node - self.size
        if leaf >= len(self.leaves):
            leaf = max(0, len(self.leaves) - 1)
            start = self.chars[1] - (len(self.leaves[leaf]) if self.leaves else 0)
        return leaf, start

    def edit(self, start: int, stop: int, text: str) -> None:
        """Replace characters [start, stop) by `text`."""
        if not self.leaves:
            fresh = cut_leaves(text)
            self._build(fresh, self._counted(fresh))
            return
        first, at = self.leaf_at(max(start - 1, 0))
        last = self.leaf_at(stop)[0]
        # One leaf of context on either side: an edit can take away the border that it touches.
        if first:
            first -= 1
            at -= len(self.leaves[first])
        last = min(last + 1, len(self.leaves) - 1)
        region = "".join(self.leaves[first : last + 1])
        fresh = cut_leaves(region[: start - at] + text + region[stop - at :])
        tokens = self._counted(fresh)
        if len(fresh) == last + 1 - first:
            self.leaves[first : last + 1] = fresh
            touched = range(first, last + 1)
            for i, leaf, n in zip(touched, fresh, tokens):
                self.tokens[self.size + i], self.chars[self.size + i] = n, len(leaf)
            nodes = {(self.size + i) // 2 for i in touched}
            while nodes - {0}:
                for node in nodes:
                    self._sum(node)
                nodes = {node // 2 for node in nodes if node > 1}
        else:  # another number of leaves: the tree above is laid out anew, known sums are kept
            known = self.tokens[self.size : self.size + len(self.leaves)]
            self._build(self.leaves[:first] + fresh + self.leaves[last + 1 :], known[:first] + tokens + known[last + 1 :])

    def text(self) -> str:
        return "".join(self.leaves)


def masking(pattern: str, mask: str) -> Callable[[str], list[tuple[int, int, str]]]:
    """Edits that put `mask` in place of every match of `pattern`."""
    found = re.compile(pattern)
    return lambda text: [(*m.span(), mask) for m in found.finditer(text)]


def usable_edits(edits: Iterable, length: int) -> list[tuple[int, int, str]]:
    """Complete edits inside the text that don't overlap one with a smaller start, in order."""
    out, end = [], 0
    for start, stop, new in sorted((a, b, c or "") for a, b, c in edits if a is not None and b is not None):
        if end <= start <= stop <= length:
            out.append((start, stop, new))
            end = stop
    return out


def count_edits(docs: DataFrame, edits: str | Callable[[str], list[tuple[int, int, str]]], ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_after, n_chars, n_chars_encoded) of every row of `docs`.

    `edits` is a column of arrays of (start, stop, text) or a function of the text that gives such a
    list: characters [start, stop) of the text as it came are replaced. They are applied from the last
    to the first, so that places stay as they are; edits that are null, overlap or lie outside the text
    are passed over. A null text is empty, null edits are none; repeated rows count alike.
    n_chars_encoded counts the characters that the encoder read again because of the edits.
    """
    names = ("doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars", "n_chars_encoded")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        count = lambda leaves: [len(b) // 4 for b in own.encode_all(list(leaves))]
        for part in parts(batches):
            out = {n: [] for n in names}
            texts = [t or "" for t in part["text"]]
            if callable(edits):
                wanted = map(edits, texts)
            else:
                wanted = ([tuple(e.values()) for e in own_ or [] if e] for own_ in part[edits])
            # The leaves of all texts of a part are counted together; edits count one region at a time.
            leaves = [cut_leaves(t) for t in texts]
            counts = iter(count([leaf for some in leaves for leaf in some]))
            for doc_id, text, some, asked in zip(part["doc_id"], texts, leaves, wanted):
                tree = CountTree(some, count, list(islice(counts, len(some))))
                before, usable = tree.total, usable_edits(asked, len(text))
                for edit in reversed(usable):
                    tree.edit(*edit)
                for name, value in zip(names, (doc_id, before, len(usable), tree.total, len(text), tree.encoded)):
                    out[name].append(value)
            yield arrow_rows(schema, out)

    columns = ["doc_id", "text"] + ([] if callable(edits) else [edits])
    return docs.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, ", ".join(f"{n} long" for n in names))
