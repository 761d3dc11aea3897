"""Byte-pair merging for many words at once.

``merge_rounds`` holds the symbols of all words in one flat array.  Each round
finds the smallest pair rank of every word (a segmented minimum), merges its
leftmost non-overlapping occurrences in all words simultaneously, compacts the
array, and ends when no pair is left.  Where a merged symbol could form a pair
of a smaller or an equal rank than its own (``careful`` ranks), one occurrence
is merged per round, so that the result is that of a priority queue which pops
(rank, position).

Long words do not lengthen the rounds of others.  First, words are cut between
two symbols that stand side by side in no piece of the vocabulary: no merge
crosses there.  What is still long is merged by local minima: a pair that comes
before all pairs within ``reach`` places is merged in this round, wherever it
is.  Only a symbol that grew over all those places could take part of it before,
and no piece is that long.  So rounds follow ``reach``, not the word's length.
"""

from __future__ import annotations

import numpy as np

from .textcore import distinct, sliding_min

NONE = np.int64(1) << 40
#: Symbols from which a word is merged by local minima.
LONG = 256


class PairTable:
    """Rank and product of each mergeable pair of symbols."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, product: np.ndarray, careful: np.ndarray, pieces: list[np.ndarray]):
        """``pieces``: the single symbols of every piece of the vocabulary."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(rank[order], NONE).astype(np.int64)
        self.products = np.append(product[order], -1).astype(np.int64)
        self.careful = careful  # boolean by rank
        size = np.array([len(p) for p in pieces], np.int64)
        flat = np.concatenate(pieces).astype(np.int64) if len(pieces) else np.empty(0, np.int64)
        self.flat, self.start, self.size = flat, np.cumsum(size) - size, size
        inner = np.ones(max(len(flat) - 1, 0), bool)
        inner[self.start[1:] - 1] = False
        self.inside = np.append(distinct(((flat[:-1] << 32) | flat[1:])[inner]), np.iinfo(np.int64).max)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (left << 32) | right
        at = np.searchsorted(self.keys, keys)
        known = self.keys[at] == keys
        return np.where(known, self.ranks[at], NONE), self.products[at]


    def together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two single symbols stand side by side in any piece."""
        keys = (left << 32) | right
        return self.inside[np.searchsorted(self.inside, keys)] == keys

    def longest(self, symbols: np.ndarray) -> int:
        """Symbols of the longest piece made of these symbols only."""
        here = np.isin(self.flat, np.unique(symbols))
        whole = np.minimum.reduceat(here, self.start) if len(self.start) else np.empty(0, bool)
        return int(self.size[whole].max(initial=1))


def merge_long(symbols: np.ndarray, table: PairTable) -> np.ndarray:
    """Final symbols of one long word, by local minima."""
    sym = symbols.astype(np.int64)
    reach = 3 * table.longest(sym)
    edge = np.full(reach, NONE)
    rank, prod = table.find(sym[:-1], sym[1:])
    while (rank < NONE).any():
        n = len(rank)
        padded = np.concatenate((edge, rank, edge))
        hit = (rank < NONE) & (rank == sliding_min(padded, 2 * reach + 1))
        # neighbours of one rank: every other one from the left, where the first of them is due
        new = np.ones(n, bool)
        new[1:] = rank[1:] != rank[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        take = hit & hit[first] & ((np.arange(n) - first) % 2 == 0)
        slow = np.flatnonzero(take)
        slow = slow[table.careful[rank[slow]]]
        if len(slow):  # only the leftmost within reach
            before = sliding_min(padded[: n + reach - 1], reach)
            take[slow] = before[slow] > rank[slow]
        at = np.flatnonzero(take)
        sym[at] = prod[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        moved = np.cumsum(keep) - 1
        sym, rank, prod = sym[keep], np.append(rank, NONE)[keep][:-1], np.append(prod, -1)[keep][:-1]
        near = distinct(np.concatenate((moved[at], moved[at] - 1)))
        near = near[(near >= 0) & (near < len(rank))]
        rank[near], prod[near] = table.find(sym[near], sym[near + 1])
    return sym


def merge_rounds(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols of all words, flat in word order, and the number for each word (lengths are positive)."""
    n_words = len(lengths)
    sym = symbols.astype(np.int64)
    of = np.repeat(np.arange(n_words), lengths)
    cut = np.ones(len(sym), bool)
    cut[1:] = (of[1:] != of[:-1]) | ~table.together(sym[:-1], sym[1:]) if len(sym) else cut[1:]
    start = np.flatnonzero(cut)
    size = np.diff(np.append(start, len(sym)))
    long = np.flatnonzero(size > LONG)
    if len(long):
        apart = np.repeat(size > LONG, size)
        parts = [merge_long(sym[a : a + n], table) for a, n in zip(start[long].tolist(), size[long].tolist(), strict=True)]
        rest, count = _rounds(sym[~apart], size[size <= LONG], table)
        # back into the order of the words
        counts = np.empty(len(size), np.int64)
        counts[long], counts[size <= LONG] = [len(p) for p in parts], count
        out = np.empty(counts.sum(), np.int64)
        apart = np.repeat(size > LONG, counts)
        out[apart], out[~apart] = np.concatenate(parts), rest
    else:
        out, counts = _rounds(sym, size, table)
    total = np.zeros(n_words, np.int64)
    np.add.at(total, of[start], counts)
    return out, total


def _rounds(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    n_words, sym = len(lengths), symbols
    word = np.repeat(np.arange(n_words), lengths)
    done_sym, done_word = [], []
    rank = np.full(len(sym), NONE)
    prod = np.full(len(sym), -1, np.int64)
    if len(sym) > 1:
        r, p = table.find(sym[:-1], sym[1:])
        rank[:-1] = np.where(word[:-1] == word[1:], r, NONE)
        prod[:-1] = p
    while len(sym):
        start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        size = np.diff(np.append(start, len(sym)))
        least = np.minimum.reduceat(rank, start)
        active = np.repeat(least < NONE, size)
        if not active.all():  # finished words leave the array
            done_sym.append(sym[~active])
            done_word.append(word[~active])
            sym, word, rank, prod = sym[active], word[active], rank[active], prod[active]
            if not len(sym):
                break
            size, least = size[least < NONE], least[least < NONE]
        least = np.repeat(least, size)
        hit = rank == least
        at = np.flatnonzero(hit)
        # occurrences that overlap form runs of neighbours: every other one is merged
        run = np.concatenate(([0], np.flatnonzero((np.diff(at) != 1) | (word[at[1:]] != word[at[:-1]])) + 1))
        run_of = np.repeat(np.arange(len(run)), np.diff(np.append(run, len(at))))
        take = (np.arange(len(at)) - run[run_of]) % 2 == 0
        first = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
        take &= first | ~table.careful[least[at]]
        at = at[take]
        sym[at] = prod[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        moved = np.cumsum(keep) - 1
        sym, word, rank, prod = sym[keep], word[keep], rank[keep], prod[keep]
        near = np.zeros(len(sym) + 1, bool)
        near[moved[at]] = near[moved[at] - 1] = True
        near[-1] = False
        changed = np.flatnonzero(near)
        inner = changed[changed + 1 < len(sym)]
        rank[changed] = NONE
        r, p = table.find(sym[inner], sym[inner + 1])
        rank[inner] = np.where(word[inner] == word[inner + 1], r, NONE)
        prod[inner] = p
    if not done_sym:
        return np.empty(0, np.int64), np.zeros(n_words, np.int64)
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], np.bincount(word, minlength=n_words)
