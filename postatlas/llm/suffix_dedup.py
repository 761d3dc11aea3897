"""Suffix-array deduplication with a run-length index.

Every byte covered by a ``length``-byte string that also starts earlier (in a
document with a smaller id, or earlier in the same one) is removed; matches
never cross documents and are judged on the input.

The corpus reaches the index as distinct anchored stretches (see
``stretches``).  Over those of a bucket the index is the run-compressed
Burrows-Wheeler transform: the symbol and the first row of each run, the text
positions at each run's ends, and the row of every ``STEP``-th text position.
The suffix array that it is built from is dropped.

* At a run's head the longest match with the preceding suffix (the end of the
  run before) is compared on the symbols; inside a run a position's statistic is
  one less than that of the position before it, so streaming the text gives all
  matching statistics.
* Stepping backward through the text from its samples, one run lookup a symbol,
  gives each position's row.

Rows whose statistics reach ``length`` form intervals of equal windows; all but
the earliest of an interval are marked.

Edge cases: a null or empty text has nothing to remove; repeated rows of one
document have one place each, so neither removes the other; rows without an id
are compared with nothing and kept whole; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .stretches import Spec, apply_removals
from .textcore import Chunk, Spans, per_document

LENGTH = 100
GRAM = 24
#: Text positions from one sampled row to the next.
STEP = 128


def suffix_ranks(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array of several byte texts by prefix doubling; a text's end sorts first, ends by the text's number."""
    n = len(symbols)
    end = np.repeat(starts + sizes, sizes)
    place = np.arange(n)
    bits = max(1, int(n).bit_length())
    packed = 3 * bits <= 63  # key and place fit one word: sorting values is far cheaper than sorting indices
    width = 5 if packed else 7
    key = np.zeros(n, np.int64)
    for d in range(width):
        shifted = np.zeros(n, np.int64)
        shifted[: n - d] = symbols[d:].astype(np.int64) + 1
        key = key * 257 + np.where(place + d < end, shifted, 0)
    longest = int(sizes.max(initial=1))
    while True:
        if packed:
            ordered = np.sort((key << bits) | place)
            order = ordered & ((1 << bits) - 1)
            ordered >>= bits
        else:
            order = np.argsort(key)
            ordered = key[order]
        new = np.ones(n, bool)
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
        if packed and (new.all() or width >= longest):  # what is left equal is so up to the texts' ends
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if new.all():
            return order
        if width >= longest:
            return np.sort(rank * n + place) % n
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:]
        after[place + width >= end] = 0
        key = (rank << bits) | after
        width *= 2


@dataclass
class RunLengthIndex:
    """Run-compressed transform of several texts with samples; all arrays but ``sampled`` have an entry for each run."""

    run_start: np.ndarray  # first row
    head: np.ndarray  # symbol, -1 before a text's start
    sample: np.ndarray  # text position at the first row
    sample_end: np.ndarray  # and at the last
    shift: np.ndarray  # from a row to that of the position before
    sampled: np.ndarray  # rows of the last position of each text's pieces of ``STEP`` positions

    @staticmethod
    def pieces(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last position of each text's pieces."""
        n = -(-sizes // STEP)
        of = np.repeat(np.arange(len(sizes)), n)
        first = starts[of] + STEP * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        return first, np.minimum(first + STEP, starts[of] + sizes[of]) - 1

    @classmethod
    def build(cls, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> RunLengthIndex:
        order = suffix_ranks(symbols, starts, sizes)
        before = np.empty(len(symbols), np.int64)
        before[1:] = symbols[:-1]
        before[starts] = -1
        bwt = before[order]
        new = np.ones(len(bwt), bool)
        new[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] < 0)
        run_start = np.flatnonzero(new)
        size = np.diff(np.append(run_start, len(bwt)))
        head = bwt[run_start]
        # a row moves to its symbol's rows: after those of smaller symbols, of texts that end with it, and of earlier runs
        count = np.bincount(symbols, minlength=256)
        least = np.cumsum(count) - count + np.bincount(symbols[starts + sizes - 1], minlength=256)
        by_head = np.argsort(head, kind="stable")
        total = np.cumsum(size[by_head]) - size[by_head]
        group = np.ones(len(head), bool)
        group[1:] = head[by_head][1:] != head[by_head][:-1]
        earlier = np.empty(len(head), np.int64)
        earlier[by_head] = total - total[np.flatnonzero(group)][np.cumsum(group) - 1]
        shift = least[np.maximum(head, 0)] + earlier - run_start
        row = np.empty(len(order), np.int64)
        row[order] = np.arange(len(order))
        return cls(run_start, head, order[run_start], order[run_start + size - 1], shift, row[cls.pieces(starts, sizes)[1]])

    def rows(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The row of every text position, by stepping backward from the samples."""
        out = np.empty(int(sizes.sum()), np.int64)
        first, at = self.pieces(starts, sizes)
        row = self.sampled
        while len(at):
            out[at] = row
            go = at > first
            first, at, row = first[go], at[go], row[go]
            row = row + self.shift[np.searchsorted(self.run_start, row, "right") - 1]
            at = at - 1
        return out

    def matching_statistics(self, symbols: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each text position the length of its match with the preceding suffix; ``end`` is its text's end."""
        here, prior = self.sample[1:], self.sample_end[:-1]
        spans = Spans(symbols)
        lo = np.zeros(len(here), np.int64)
        hi = np.minimum(end[here] - here, end[prior] - prior)
        while (open_ := lo < hi).any():
            m = (lo + hi + 1) >> 1
            m = np.where(open_, m, lo)
            equal = spans.hash(here, here + m) == spans.hash(prior, prior + m)
            lo, hi = np.where(open_ & equal, m, lo), np.where(open_ & ~equal, m - 1, hi)
        head = np.zeros(len(symbols), bool)
        head[self.sample] = True
        value = np.zeros(len(symbols), np.int64)
        value[here] = lo
        at = np.flatnonzero(head)
        last = at[np.cumsum(head) - 1]
        return np.maximum(value[last] - (np.arange(len(symbols)) - last), 0)


def later_windows(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, key: np.ndarray) -> np.ndarray:
    """Which positions start a window that also starts at a smaller key."""
    index = RunLengthIndex.build(symbols, starts, sizes)
    statistic = index.matching_statistics(symbols, np.repeat(starts + sizes, sizes))
    row = index.rows(starts, sizes)
    new, ordered = np.empty(len(row), bool), np.empty(len(row), np.int64)
    new[row] = statistic < length
    ordered[row] = key
    new[:1] = True
    first = np.minimum.reduceat(ordered, np.flatnonzero(new))
    return key > first[np.cumsum(new)[row] - 1]


def places(doc: np.ndarray, at: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """An order of all positions by document, then place."""
    rank = np.unique(doc, return_inverse=True)[1].astype(np.int64)
    return np.repeat((rank << 32) + at - starts, sizes) + np.arange(sizes.sum())


def _index(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, doc: np.ndarray, at: np.ndarray, length: int = LENGTH) -> np.ndarray:
    return later_windows(symbols, starts, sizes, length, places(doc, at, starts, sizes))


def spec(length: int = LENGTH, gram: int = GRAM) -> Spec:
    return Spec(length, min(gram, length), False, False, lambda *a: _index(*a, length=length))


def _finish(c: Chunk, flag: np.ndarray, first: np.ndarray, _: None) -> pa.RecordBatch:
    edge = flag.copy()
    edge[1:] &= ~flag[:-1]
    inner = first[(first > 0) & (first < len(flag))]
    edge[inner] = flag[inner]
    removed = per_document(flag, first)
    at = first.tolist()
    kept = [c.buf[a:b][~flag[a:b]].tobytes() if r else c.buf[a:b].tobytes() for a, b, r in zip(at[:-1], at[1:], removed.tolist(), strict=True)]
    return pa.RecordBatch.from_pydict({"doc_id": c.ids.cast(pa.int64()), "n_bytes": np.diff(first), "n_removed": removed, "n_spans": per_document(edge, first), "kept_bytes": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_bytes) of every row."""
    return apply_removals(docs, spec(length), _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """As ``remove_repeats``, with the hash of the kept bytes in their place; hashed where they are made."""

    def finish(c: Chunk, flag: np.ndarray, first: np.ndarray, words: None) -> pa.RecordBatch:
        b = _finish(c, flag, first, words)
        shas = pa.array([hashlib.sha256(x).hexdigest() for x in b.column("kept_bytes").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*b.columns[:4], shas], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return apply_removals(docs, spec(length), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


__all__ = ["RunLengthIndex", "digests", "later_windows", "places", "remove_repeats", "spec", "suffix_ranks"]
