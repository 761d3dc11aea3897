"""Prefix-partitioned suffix trees: leaves, common prefixes and deep nodes against plain ones."""

import random

import numpy as np
import pytest

from postatlas.llm import substring_dedup as sd


def bucket(seed, longest=60):
    rnd = random.Random(seed)
    base = [rnd.randrange(1, 6) for _ in range(200)]
    texts = []
    for _ in range(rnd.randint(1, 12)):
        a = rnd.randrange(len(base))
        texts.append([rnd.randrange(1, 6) for _ in range(rnd.randint(0, 6))] + base[a : a + rnd.randint(1, longest)])
    texts.append([7] * 45)  # repeats within itself
    sizes = np.array([len(t) for t in texts])
    return texts, np.array(sum(texts, []), np.uint64), np.cumsum(sizes) - sizes, sizes


@pytest.mark.parametrize("seed", range(25))
def test_against_plain_tree(seed):
    texts, words, starts, sizes = bucket(seed)
    suffix = {int(s) + p: t[p:] for s, t in zip(starts, texts) for p in range(len(t))}
    ladder = sd.PrefixLadder(words, starts, sizes)
    leaves, shared = sd.subtree(ladder, np.arange(len(words)))
    ordered = [suffix[i] for i in leaves.tolist()]
    assert ordered == sorted(suffix.values())

    def common(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k

    assert shared.tolist() == [0] + [common(a, b) for a, b in zip(ordered, ordered[1:])]
    for length in (3, 9):
        first, end, depth = sd.deep_nodes(shared, length)
        groups = {}
        for i, t in suffix.items():
            if len(t) >= length:
                groups.setdefault(tuple(t[:length]), []).append(i)
        want = {frozenset(g): g for g in groups.values() if len(g) > 1}
        got = {frozenset(leaves[a:b].tolist()): d for a, b, d in zip(first.tolist(), end.tolist(), depth.tolist())}
        assert got.keys() == want.keys()
        for g, d in got.items():  # the depth is what all leaves below share
            some = [suffix[i] for i in g]
            assert d == min(common(some[0], t) for t in some[1:])


@pytest.mark.parametrize("seed", range(25))
@pytest.mark.parametrize("group", [1, 5, 40, 1 << 14])
def test_marks_do_not_depend_on_the_groups(seed, group):
    texts, words, starts, sizes = bucket(seed)
    rnd = np.random.default_rng(seed)
    doc = rnd.integers(0, 4, len(texts))
    got = sd._index(words, starts, sizes, doc, np.zeros(len(texts), int), length=5, group=group)
    seen = {}
    for d, t in zip(doc.tolist(), texts):
        for p in range(len(t) - 4):
            seen[tuple(t[p : p + 5])] = min(seen.get(tuple(t[p : p + 5]), 99), d)
    want = [p + 5 <= len(t) and seen[tuple(t[p : p + 5])] < d for d, t in zip(doc.tolist(), texts) for p in range(len(t))]
    assert got.tolist() == want
