"""Anchors that very many different stretches share are split; the steps run here one by one, without a cluster."""

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from postatlas.llm import stretches, substring_dedup, suffix_dedup
from postatlas.llm.stretches import MARK, UNITS, _batch, _kinds
from postatlas.llm.textcore import unpack_all

G = 5


def grouped(tables):
    out = {}
    for t in tables:
        for b, kind, payload in zip(*(t.column(i).to_pylist() for i in range(3)), strict=True):
            out.setdefault(b, []).append((b, kind, payload))
    return {b: pa.Table.from_batches([_batch(r)]) for b, r in out.items()}


def removed(parts, spec):
    """(document, unit) that go, and the messages with units; each part of the documents is a flush."""
    asked = [t for part in parts for t in stretches._step1(spec, G)([part])]
    marks = sum(len(unpack_all(_kinds(t).get(MARK, []), np.uint64)[0]) for t in asked)
    asked = grouped(stretches._step2(spec, G)(t) for t in grouped(asked).values())
    whole = pa.Table.from_batches(parts)
    empty = pa.Table.from_batches([_batch([])])
    sent = [stretches._step3(spec, G)(whole.filter(pa.array([i % G == b for i in whole.column("doc_id").to_pylist()])), asked.get(b, empty)) for b in range(G)]
    sizes = [int(np.frombuffer(p, np.int64, 1)[0]) for t in sent for p in _kinds(t).get(UNITS, [])]
    gone = set()
    for t in (stretches._step4(spec, G)(x) for x in grouped(sent).values()):
        for d, s, n in zip(*unpack_all(_kinds(t).get(stretches.REMOVE, []), *stretches._REMOVE), strict=True):
            gone |= {(int(d), k) for k in range(s, s + n)}
    return gone, marks, sum(sizes)


def plain(rows, length, words, other_document):
    first, gone = {}, set()
    for d, t in sorted(rows):
        u = t.split() if words else t.encode()
        for k in range(len(u) - length + 1):
            w = tuple(u[k : k + length])
            if w not in first:
                first[w] = d
            elif not other_document or first[w] < d:
                gone |= {(d, k + j) for j in range(length)}
    return gone


def texts(words):
    rng = np.random.default_rng(3)
    core = "the seven common words of every single page here now"
    out = []
    for i in range(60):
        before, after = (" ".join(f"w{x}" for x in rng.integers(0, 40, 12)) for _ in range(2))
        out.append((i, f"{before} {core} {after}"))
    for i in range(60, 90):  # copies in part, in whole, and within a document
        a, b = out[rng.integers(0, 60)][1], out[rng.integers(0, 60)][1]
        out.append((i, a[: rng.integers(40, len(a))] + " " + b if i % 3 else a + " " + a))
    out += [(90, out[5][1]), (91, out[5][1]), (92, "x " * 60), (93, "x " * 60), (94, "")]
    return out


@pytest.mark.parametrize("words", [True, False])
def test_hot_anchors_lose_nothing(words):
    rows = texts(words)
    base = substring_dedup.spec(14, 4) if words else replace(suffix_dedup.spec(60, 12), gram=12)
    parts = [pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in x], pa.int64()), "text": [t for _, t in x]}) for x in (rows[::-1][:20], rows[:40], rows[40:75])]
    want = plain(rows, base.length, words, base.other_document)
    assert want
    calm, marks, _ = removed(parts, replace(base, hot=1 << 20))
    assert marks == 0 and calm == want
    for hot in (2, 10):  # some flushes have marked anchors, others not
        got, marks, _ = removed(parts, replace(base, hot=hot))
        assert marks > 0 and got == want


def test_a_hot_anchor_reaches_many_buckets():
    rows = texts(True)[:60]
    part = pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": [t for _, t in rows]})
    spec = substring_dedup.spec(14, 4)
    sent = next(stretches._step1(replace(spec, hot=10), G)([part]))
    kinds = _kinds(sent)
    marked = unpack_all(kinds[MARK], np.uint64)[0]
    q = {b: unpack_all([p for x, k, p in zip(*(sent.column(i).to_pylist() for i in range(3)), strict=True) if k == stretches.QUERY and x == b], *stretches._QUERY) for b in range(G)}
    of = [int(np.isin(q[b][0], marked[:1]).sum()) for b in range(G)]
    assert sum(of) >= 10 and max(of) < sum(of)
