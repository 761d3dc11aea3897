"""The run-length index: rows, statistics and marks against a plain suffix array."""

import random

import numpy as np
import pytest

from postatlas.llm import suffix_dedup as sd


def texts(seed):
    rnd = random.Random(seed)
    base = bytes(rnd.choice(b"abcd") for _ in range(300))
    out = []
    for _ in range(rnd.randint(1, 9)):
        a = rnd.randrange(280)
        out.append(bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randint(0, 9))) + base[a : a + rnd.randint(1, 200)])
    return out + [out[0], b"z" * rnd.randint(1, 400), b"q"]


@pytest.mark.parametrize("seed", range(30))
def test_index(seed):
    some = texts(seed)
    sizes = np.array([len(t) for t in some])
    starts = np.cumsum(sizes) - sizes
    symbols = np.frombuffer(b"".join(some), np.uint8)
    suffixes = sorted((t[p:], k, int(starts[k]) + p) for k, t in enumerate(some) for p in range(len(t)))
    index = sd.RunLengthIndex.build(symbols, starts, sizes)
    rows = index.rows(starts, sizes)
    assert rows[[p for *_, p in suffixes]].tolist() == list(range(len(symbols)))
    assert len(index.head) == len(index.run_start) == len(index.shift) and len(index.sampled) == sum(-(-n // sd.STEP) for n in sizes)

    def common(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k

    want = np.zeros(len(symbols), int)
    for (a, _, _), (b, _, p) in zip(suffixes, suffixes[1:]):
        want[p] = common(a, b)
    assert index.matching_statistics(symbols, np.repeat(starts + sizes, sizes)).tolist() == want.tolist()
    key = np.random.default_rng(seed).permutation(len(symbols))
    first = {}
    for k, t in enumerate(some):
        for p in range(len(t) - 6):
            first[t[p : p + 7]] = min(first.get(t[p : p + 7], 1 << 40), key[starts[k] + p])
    late = [p + 7 <= len(t) and first[t[p : p + 7]] < key[starts[k] + p] for k, t in enumerate(some) for p in range(len(t))]
    assert sd.later_windows(symbols, starts, sizes, 7, key).tolist() == late


def test_repetitive_texts_have_few_runs():
    rnd = random.Random(1)
    base = bytes(rnd.choice(b"abcdefgh ") for _ in range(2000))
    some = [base[: 1900 + k] for k in range(60)]
    sizes = np.array([len(t) for t in some])
    index = sd.RunLengthIndex.build(np.frombuffer(b"".join(some), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert len(index.head) < sizes.sum() / 25
