"""Exact repeats of a fixed length across a corpus, found through anchored stretches.

A *window* is ``length`` consecutive units (bytes or words) of one document.
Each window has an anchor: the smallest fingerprint of its grams of ``gram``
units, so equal windows have equal anchors.  Consecutive windows with one
anchor form a *stretch*.  Four steps follow, all of them keyed exchanges of
packed arrays:

1. scan: each task sends one row for each distinct stretch of a flush (anchor,
   fingerprint, earliest place); later copies in the flush are settled there,
   so a hot stretch costs a row for each flush, not for each document;
2. by anchor: later copies of one stretch are settled; where an anchor has
   several different stretches, or a stretch may repeat within itself, their
   units are asked for;
3. by document: the units are sent, once for each distinct stretch;
4. by anchor: an index over the bucket's stretches (a run-length index or
   suffix trees) finds each window that also starts earlier.

An anchor that many different stretches share (``HOT_STRETCHES`` or more, in one
flush or in the anchor's bucket) is hot for all of them: where it is so in a
flush, the flush sends a mark to the anchor's bucket, and the stretches to
buckets by anchor and fingerprint.  The units of a hot anchor's stretches are
dealt by second anchors, of nearly a window's size, after equal parts are
settled where the documents are; a part alone with its second anchor has no
partner and stays out of the index.  Equal windows have equal second anchors
too, so nothing is lost, and no index holds a hot anchor's contexts: the
anchor's bucket gets a mark, or fewer places than the limit, from each flush.

The result is the covered units of each document, applied where the documents
are (the exchange of the documents by group is the one of step 3, reused).
Group and bucket numbers grow with the input, so each is of a bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scale import groups
from .textcore import SPACE_WORDS, U64, Chunk, Spans, chunks, covered, distinct, mix, owner, pack, sliding_min, split_words, unpack_all, word_hashes

MESSAGE = "b long, kind int, payload binary"
_SCHEMA = pa.schema([("b", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
QUERY, REMOVE, ASK, UNITS, MARK = range(5)
_QUERY = (U64, U64, np.int64, np.int32, np.int32)  # anchor, fingerprint, document, start, windows
_REMOVE = (np.int64, np.int32, np.int32)  # document, start, units
_ASK = (U64, U64, np.int64, np.int32, np.int32)
#: Added to a stretch's number of windows where it may repeat within itself.
SELF = 1 << 30
#: Added to it where the anchor is hot.
HOT = 1 << 29
#: Different stretches of one anchor, in one flush or in its bucket, that make the anchor hot.
HOT_STRETCHES = 32
#: Text bytes whose stretches are compared within a task before they are sent.
FLUSH_BYTES = 16 << 20


@dataclass(frozen=True)
class Spec:
    length: int
    gram: int
    words: bool  # units are words, else bytes
    #: a copy counts if it is in a smaller document only; else also earlier in the same one
    other_document: bool
    #: (units, starts, sizes, document, start in document) -> flag for each unit: a window that also starts earlier begins here
    index: Callable[..., np.ndarray]
    hot: int = HOT_STRETCHES

    @property
    def places(self) -> int:
        """Places of a second anchor in a window."""
        return max(1, (self.length - self.gram) // 4)


def units(c: Chunk, spec: Spec) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray] | None]:
    """The units of a chunk, each document's first unit, and the words' places in bytes."""
    if not spec.words:
        return c.buf, c.offs, None
    starts, ends, first = split_words(c.buf, c.offs, SPACE_WORDS)
    return word_hashes(c.buf, starts, ends), first, (starts, ends)


def scan(c: Chunk, spec: Spec) -> list[np.ndarray]:
    """The stretches of a chunk, as columns of _QUERY."""
    u, first, _ = units(c, spec)
    if len(u) < spec.length:
        return [np.empty(0, t) for t in _QUERY]
    spans, w = Spans(u), spec.length - spec.gram + 1
    grams = spans.windows(spec.gram)
    least = sliding_min(grams, w)
    of = owner(first)
    valid = of[: len(least)] == of[spec.length - 1 :]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (of[1 : len(least)] != of[: len(least) - 1])
    start = np.flatnonzero(new)
    stop = new | ~valid
    ends = np.append(np.flatnonzero(stop), len(least))
    n = ends[np.searchsorted(ends, start, "right")] - start
    doc = of[start]
    ids = c.id_values
    windows = n
    if not spec.other_document:  # an anchor found twice in a stretch: a window may repeat within it
        edge = np.zeros(w - 1, U64)
        anchors = np.flatnonzero(grams == ~sliding_min(~np.concatenate((edge, np.where(valid, least, U64(0)), edge)), w))
        lo, hi = np.searchsorted(anchors, start), np.searchsorted(anchors, start + n + w - 1)
        k = hi - lo
        of_stretch = np.repeat(np.arange(len(start)), k)
        near = anchors[np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(k.sum())]
        own = np.bincount(of_stretch[grams[near] == least[start][of_stretch]], minlength=len(start))
        windows = n + np.where(own > 1, SELF, 0)
    return [least[start], spans.hash(start, start + n + spec.length - 1), ids[doc].astype(np.int64), (start - first[doc]).astype(np.int32), windows.astype(np.int32)]


def _dealt(kind: int, b: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    order = np.argsort(b, kind="stable")
    b = b[order]
    columns = [x[order] for x in columns]
    cut = np.flatnonzero(np.diff(b)) + 1
    for i, j in zip(np.append(0, cut).tolist(), np.append(cut, len(b)).tolist(), strict=True):
        if j > i:
            yield int(b[i]), kind, pack(*(x[i:j] for x in columns))


def _batch(rows: Iterable[tuple[int, int, bytes]]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _SCHEMA.field(i).type) for i in range(3)], schema=_SCHEMA)


def _bucket(anchor: np.ndarray, n: int) -> np.ndarray:
    return (anchor >> U64(20)).astype(np.int64) % n


def _merged_spans(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The union of each document's spans."""
    if not len(doc):
        return [np.empty(0, t) for t in _REMOVE]
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order].astype(np.int64)
    end = start + size[order]
    new_doc = np.concatenate(([True], doc[1:] != doc[:-1]))
    rank = np.cumsum(new_doc) - 1
    wide = np.int64(1) << 33
    reach = np.maximum.accumulate(end + rank * wide) - rank * wide
    new = new_doc.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return [doc[at], start[at].astype(np.int32), (reach[last] - start[at]).astype(np.int32)]


def _settle(q: list[np.ndarray], spec: Spec) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sorted columns; those to pass on (the earliest place, or all of the smallest document), and those that are later copies."""
    order = np.lexsort((q[3], q[2], q[1], q[0]))
    q = [x[order] for x in q]
    new = np.ones(len(order), bool)
    new[1:] = (q[0][1:] != q[0][:-1]) | (q[1][1:] != q[1][:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.empty(0, np.int64)
    same_doc = q[2] == q[2][head]
    if spec.other_document:
        return same_doc, ~same_doc, q
    return new, ~(same_doc & (q[3] == q[3][head])), q


def _contexts(q: list[np.ndarray]) -> np.ndarray:
    """For each of the sorted stretches: how many different ones its anchor has."""
    anchor = np.ones(len(q[0]), bool)
    anchor[1:] = q[0][1:] != q[0][:-1]
    new = anchor.copy()
    new[1:] |= q[1][1:] != q[1][:-1]
    of = np.cumsum(anchor) - 1
    return np.bincount(of, new, int(anchor.sum()))[of]


def _removals(q: list[np.ndarray], spec: Spec, g: int) -> Iterator[tuple[int, int, bytes]]:
    r = _merged_spans(q[2], q[3], (q[4] & (HOT - 1)) + (spec.length - 1))
    return _dealt(REMOVE, r[0] % g, r)


def _step1(spec: Spec, g: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[list[np.ndarray]]) -> pa.RecordBatch:
            q = [np.concatenate(x) for x in zip(*held, strict=True)]
            ask, late, q = _settle(q, spec)
            sent = [x[ask] for x in q]
            hot = _contexts(sent) >= spec.hot
            sent[4] = sent[4] | np.where(hot, HOT, 0).astype(np.int32)
            marks = distinct(sent[0][hot])
            to = _bucket(np.where(hot, mix(sent[0] + sent[1]), sent[0]), g)
            return _batch([*_dealt(QUERY, to, sent), *_dealt(MARK, _bucket(marks, g), [marks]), *_removals([x[late] for x in q], spec, g)])

        held, size = [], 0
        for c in chunks(batches):
            held.append(scan(c, spec))
            size += len(c.buf)
            if size >= FLUSH_BYTES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def _kinds(table: pa.Table) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for k, p in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True):
        out.setdefault(k, []).append(p)
    return out


def _step2(spec: Spec, g: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        b = table.column("b")[0].as_py()
        rows = [(b, REMOVE, p) for p in kinds.get(REMOVE, [])]
        if QUERY in kinds:
            q = unpack_all(kinds[QUERY], *_QUERY)
            ask, late, q = _settle(q, spec)
            rows += _removals([x[late] for x in q], spec, g)
            q = [x[ask] for x in q]
            marks = unpack_all(kinds.get(MARK, []), U64)[0]
            n = _contexts(q)
            q[4] = q[4] | np.where((n >= spec.hot) | np.isin(q[0], marks), HOT, 0).astype(np.int32)
            q = [x[(n > 1) | (q[4] >= HOT)] for x in q]
            rows += _dealt(ASK, q[2] % g, q)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _rows_of(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted id that is there: its index in ``wanted`` and its first row."""
    order = np.argsort(ids, kind="stable")
    at = np.searchsorted(ids[order], wanted)
    there = np.flatnonzero((at < len(ids)) & (ids[order][np.minimum(at, len(ids) - 1)] == wanted)) if len(ids) else np.empty(0, np.int64)
    return there, order[at[there]]


def _units(u: np.ndarray, g: int, key: np.ndarray, alone: np.ndarray, doc: np.ndarray, at: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """The units of stretches, one message for each bucket; with each its key, 0 where it may repeat alone."""
    b = _bucket(key, g)
    order = np.argsort(b, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(b[order])) + 1):
        if len(part):
            s = size[part]
            flat = u[np.repeat(start[part] - (np.cumsum(s) - s), s) + np.arange(s.sum())]
            head = pack(np.array([len(part)]), doc[part], at[part], s.astype(np.int32), np.where(alone[part], U64(0), key[part]))
            yield int(b[part[0]]), UNITS, head + flat.tobytes()


def _finer(spans: Spans, spec: Spec, start: np.ndarray, n: np.ndarray, doc: np.ndarray, at: np.ndarray, alone: np.ndarray) -> list[np.ndarray]:
    """Stretches (their first windows and numbers of windows) cut where the second anchor changes: columns of _QUERY, and each part's first unit."""
    least = sliding_min(spans.windows(spec.length - spec.places + 1), spec.places)
    of = np.repeat(np.arange(len(start)), n)
    w = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    key = least[start[of] + w]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (key[1:] != key[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(of)))
    begin = start[of[first]] + w[first]
    return [key[first], spans.hash(begin, begin + size + spec.length - 1), doc[of[first]], (at[of[first]] + w[first]).astype(np.int32), (size | alone[of[first]]).astype(np.int32), begin]


def _step3(spec: Spec, g: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        rows = []
        if REMOVE in kinds:
            r = _merged_spans(*unpack_all(kinds[REMOVE], *_REMOVE))
            rows += _dealt(REMOVE, r[0] % g, r)
        if ASK in kinds and docs.num_rows:
            q = unpack_all(kinds[ASK], *_ASK)
            order = np.lexsort((q[3], q[2], q[0]))
            q = [x[order] for x in q]
            new = np.ones(len(order), bool)  # a repeated row may have asked too
            new[1:] = (q[0][1:] != q[0][:-1]) | (q[2][1:] != q[2][:-1]) | (q[3][1:] != q[3][:-1])
            q = [x[new] for x in q]
            parts = []
            open_ = np.ones(len(q[0]), bool)
            for c in chunks(docs.to_batches()):
                u, first, _ = units(c, spec)
                hit, row = _rows_of(c.id_values, q[2][open_])
                hit = np.flatnonzero(open_)[hit]
                start = first[row] + q[3][hit]
                size = (q[4][hit] & (HOT - 1)).astype(np.int64) + (spec.length - 1)
                inside = start + size <= first[row + 1]
                hit, start, size = hit[inside], start[inside], size[inside]
                if not len(hit):
                    continue
                spans = Spans(u)
                equal = spans.hash(start, start + size) == q[1][hit]
                hit, start, size = hit[equal], start[equal], size[equal]
                open_[hit] = False
                hot = (q[4][hit] & HOT) > 0
                alone = q[4][hit] & SELF
                cool = [x[~hot] for x in (q[0][hit], alone > 0, q[2][hit], q[3][hit], start, size)]
                rows += _units(u, g, *cool)
                if hot.any():
                    part = _finer(spans, spec, start[hot], size[hot] - (spec.length - 1), q[2][hit[hot]], q[3][hit[hot]], alone[hot])
                    size = (part[4] & (HOT - 1)).astype(np.int64) + (spec.length - 1)
                    flat = np.repeat(part[5] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    parts.append((part[:5], u[flat]))
            if parts:
                fine = [np.concatenate([p[0][i] for p in parts]) for i in range(5)]
                flat = np.concatenate([p[1] for p in parts])
                size = (fine[4] & (HOT - 1)).astype(np.int64) + (spec.length - 1)
                start = np.cumsum(size) - size
                order = np.lexsort((fine[3], fine[2], fine[1], fine[0]))
                ask, late, fine = _settle(fine, spec)
                rows += _removals([x[late] for x in fine], spec, g)
                rows += _units(flat, g, fine[0][ask], fine[4][ask] >= SELF, fine[2][ask], fine[3][ask], start[order][ask], size[order][ask])
        return pa.Table.from_batches([_batch(rows)])

    return run


def _step4(spec: Spec, g: int) -> Callable[[pa.Table], pa.Table]:
    kind = U64 if spec.words else np.uint8

    def run(table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        b = table.column("b")[0].as_py()
        rows = [(b, REMOVE, p) for p in kinds.get(REMOVE, [])]
        doc, at, size, key, flat = [], [], [], [], []
        for p in kinds.get(UNITS, []):
            n = int(np.frombuffer(p, np.int64, 1)[0])
            doc.append(np.frombuffer(p, np.int64, n, 8))
            at.append(np.frombuffer(p, np.int32, n, 8 + 8 * n))
            size.append(np.frombuffer(p, np.int32, n, 8 + 12 * n))
            key.append(np.frombuffer(p, U64, n, 8 + 16 * n))
            flat.append(np.frombuffer(p[8 + 24 * n :], kind))
        if doc:
            doc, at, size, key, flat = (np.concatenate(x) for x in (doc, at, size, key, flat))
            _, of, times = np.unique(key, return_inverse=True, return_counts=True)
            some = (times[of] > 1) | (key == 0)  # the only part with its anchor has no partner
            doc, at, size, flat = doc[some], at[some], size[some], flat[np.repeat(some, size)]
            starts = np.cumsum(size.astype(np.int64)) - size
            flag = spec.index(flat, starts, size.astype(np.int64), doc, at.astype(np.int64)) if len(flat) else np.empty(0, bool)
            hit = np.flatnonzero(flag)
            of = np.searchsorted(starts, hit, "right") - 1
            r = _merged_spans(doc[of], (at[of] + hit - starts[of]).astype(np.int32), np.full(len(hit), spec.length, np.int32))
            rows += _dealt(REMOVE, r[0] % g, r)
        return pa.Table.from_batches([_batch(rows)])

    return run


def apply_removals(docs: DataFrame, spec: Spec, finish: Callable[[Chunk, np.ndarray, np.ndarray, tuple | None], pa.RecordBatch], schema: str) -> DataFrame:
    """``finish`` of every chunk of documents with its units' removal flags (and each document's first unit, and the words' places).

    ``docs`` has doc_id (long) and text.  Rows without an id are compared with nothing.
    """
    g = groups(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.where("doc_id is not null").withColumn("b", F.pmod("doc_id", F.lit(g)))
    asked = rows.where("doc_id is not null").mapInArrow(_step1(spec, g), MESSAGE).groupBy("b").applyInArrow(_step2(spec, g), MESSAGE)
    sent = dealt.groupBy("b").cogroup(asked.groupBy("b")).applyInArrow(_step3(spec, g), MESSAGE)
    removals = sent.groupBy("b").applyInArrow(_step4(spec, g), MESSAGE)

    def last(docs: pa.Table, table: pa.Table) -> pa.Table:
        r = _merged_spans(*unpack_all(_kinds(table).get(REMOVE, []), *_REMOVE))
        return pa.Table.from_batches([_finished(c, r) for c in chunks(docs.to_batches())] or [_finished(_EMPTY, r)])

    def _finished(c: Chunk, r: list[np.ndarray]) -> pa.RecordBatch:
        u, first, places = units(c, spec)
        if c.ids.null_count or not len(r[0]):
            flag = np.zeros(len(u), bool)
        else:  # every row of a document, repeated ones too
            lo, hi = np.searchsorted(r[0], c.id_values), np.searchsorted(r[0], c.id_values, "right")
            n = hi - lo
            row = np.repeat(np.arange(len(c)), n)
            k = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            end = np.minimum(r[1][k].astype(np.int64) + r[2][k], first[row + 1] - first[row])
            start = np.minimum(r[1][k], end)
            flag = covered(first[row] + start, end - start, len(u))
        return finish(c, flag, first, places)

    out = dealt.groupBy("b").cogroup(removals.groupBy("b")).applyInArrow(last, schema)
    nameless = rows.where("doc_id is null").mapInArrow(lambda it: (_finished(c, [np.empty(0, t) for t in _REMOVE]) for c in chunks(it)), schema)
    return out.unionByName(nameless)


_EMPTY = Chunk(pa.array([], pa.int64()), np.empty(0, np.uint8), np.zeros(1, np.int64))

__all__ = ["Spec", "apply_removals", "scan", "units"]
