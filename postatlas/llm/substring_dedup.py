"""Substring deduplication with prefix-partitioned suffix trees.

Every word covered by a window of ``length`` words whose word sequence also
starts in a document with a smaller id is removed; windows are judged on the
input.

The corpus reaches the trees as distinct anchored stretches (see
``stretches``): suffixes are dealt by the anchor gram of their window.  Within
a bucket, variable-length prefixes split the suffixes into groups of at most
``group`` suffixes: a group that is too large is split by a prefix twice as
long.  Each group becomes one subtree: its leaves in lexicographic order, the
longest common prefixes of neighbours, and the internal nodes of a depth of
``length`` words or more that have no such node above (an interval of leaves
whose neighbours share ``length`` words; its depth is the least of them).  The
string of a deep node is a repeat that no word prolongs at all of its places:
where it also starts in a smaller document, the whole of it goes.

Ranks of prefixes are made once for a bucket, by doubling; subtrees are built
one after another.

Edge cases: a null text has no words; documents of fewer words than a window
lose nothing; repeated rows of one document do not remove each other; rows
without an id are kept whole; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .stretches import Spec, apply_removals
from .textcore import Chunk, per_document

LENGTH = 50
GRAM = 8
#: Suffixes in one subtree.
GROUP = 1 << 14


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


class PrefixLadder:
    """Lexicographic ranks of the prefixes of 1, 2, 4 ... words of all suffixes; what has ended comes first."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        n = len(words)
        self.room = np.repeat(starts + sizes, sizes) - np.arange(n)
        self.steps = [_dense(words)]
        width, longest = 1, int(sizes.max(initial=1))
        while width < longest:
            s = self.steps[-1]
            after = np.zeros(n, np.int64)
            more = np.flatnonzero(self.room > width)
            after[more] = s[more + width] + 1
            self.steps.append(_dense(s * (n + 1) + after))
            width *= 2

    def partition(self, suffixes: np.ndarray, group: int, length: int) -> Iterator[np.ndarray]:
        """Groups of suffixes by variable-length prefixes of ``length`` words at most, small neighbours packed together."""
        levels = min(len(self.steps), length.bit_length())

        def split(part: np.ndarray, level: int) -> Iterator[np.ndarray]:
            if len(part) <= group or level == levels:
                yield part
                return
            key = self.steps[level][part]
            order = np.argsort(key, kind="stable")
            for sub in np.split(part[order], np.flatnonzero(np.diff(key[order])) + 1):
                yield from split(sub, level + 1)

        held: list[np.ndarray] = []
        size = 0
        for part in split(suffixes, 0):
            if held and size + len(part) > group:
                yield np.concatenate(held)
                held, size = [], 0
            held.append(part)
            size += len(part)
        if held:
            yield np.concatenate(held)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The words that two suffixes have in common at their start."""
        most = np.minimum(self.room[a], self.room[b])
        done = np.zeros(len(a), np.int64)
        for level in range(len(self.steps) - 1, -1, -1):
            go = done < most
            at = np.where(go, done, 0)
            equal = go & (self.steps[level][a + at] == self.steps[level][b + at])
            done = np.where(equal, done + (1 << level), done)
        return np.minimum(done, most)


def subtree(ladder: PrefixLadder, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves in lexicographic order, and for each the words that it shares with the one before (0 for the first)."""
    leaves = suffixes[np.argsort(ladder.steps[-1][suffixes], kind="stable")]
    shared = np.zeros(len(leaves), np.int64)
    shared[1:] = ladder.common(leaves[:-1], leaves[1:])
    return leaves, shared


def deep_nodes(shared: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The highest internal nodes of a depth of ``length`` or more: first leaf, end of the leaves, and depth of each."""
    deep = shared >= length
    first = np.flatnonzero(deep & ~np.append(False, deep[:-1])) - 1
    end = np.flatnonzero(deep & ~np.append(deep[1:], False)) + 1
    # the depth is the least value between neighbours, the first leaf's own value left out
    bounds = np.stack((first + 1, end), axis=1).ravel()
    depth = np.minimum.reduceat(np.append(shared, 0), bounds)[::2] if len(first) else np.empty(0, np.int64)
    return first, end, depth


def _index(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, doc: np.ndarray, at: np.ndarray, length: int = LENGTH, group: int = GROUP) -> np.ndarray:
    ladder = PrefixLadder(words, starts, sizes)
    docs = np.repeat(doc, sizes)
    edge = np.zeros(len(words) + 1, np.int64)
    for part in ladder.partition(np.flatnonzero(ladder.room >= length), group, length):
        leaves, shared = subtree(ladder, part)
        first, end, depth = deep_nodes(shared, length)
        if not len(first):
            continue
        n = end - first
        node = np.repeat(np.arange(len(n)), n)
        leaf = leaves[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        least = np.minimum.reduceat(docs[leaf], np.cumsum(n) - n)
        late = docs[leaf] > least[node]
        # every window inside the node's string starts in the smaller document too
        np.add.at(edge, leaf[late], 1)
        np.add.at(edge, leaf[late] + (depth[node][late] - length + 1), -1)
    return np.cumsum(edge[:-1]) > 0


def spec(length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> Spec:
    return Spec(length, min(gram, length), True, True, lambda *a: _index(*a, length=length, group=group))


def kept_texts(c: Chunk, flag: np.ndarray, first: np.ndarray, places: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """The kept words of each document, joined by one space."""
    starts, ends = places
    keep = ~flag
    size = (ends - starts + 1)[keep]  # with a space after each
    s = starts[keep]
    if not len(s):
        return [b""] * len(c)
    total = int(size.sum())
    at = np.repeat(s - (np.cumsum(size) - size), size) + np.arange(total)
    flat = c.buf[np.minimum(at, len(c.buf) - 1)]
    flat[np.cumsum(size) - 1] = 0x20
    raw = flat.tobytes()
    cut = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(keep)))[first]].tolist()
    return [raw[a : max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _columns(c: Chunk, flag: np.ndarray, first: np.ndarray) -> dict:
    return {"doc_id": c.ids.cast(pa.int64()), "n_words": np.diff(first).astype(np.int64), "n_removed": per_document(flag, first)}


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row."""

    def finish(c: Chunk, flag: np.ndarray, first: np.ndarray, places: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({**_columns(c, flag, first), "kept_text": pa.array(kept_texts(c, flag, first, places), pa.binary()).cast(pa.string())})

    return apply_removals(docs, spec(length), finish, "doc_id long, n_words long, n_removed long, kept_text string")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """As ``remove_repeats``, with the hash of the kept words in their place."""

    def finish(c: Chunk, flag: np.ndarray, first: np.ndarray, places: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({**_columns(c, flag, first), "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept_texts(c, flag, first, places)]})

    return apply_removals(docs, spec(length), finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")
