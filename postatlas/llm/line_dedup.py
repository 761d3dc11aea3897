"""Line deduplication by a deletion-neighbourhood join.

A line is removed if an earlier line (of a smaller document, or earlier in the
same one) has the same words, or, from ``min_words`` words on, words within an
edit distance of one word (one replaced, inserted or deleted).  Lines are
judged on the input; lines without words stay.

1. Equal lines are settled by fingerprint, first within a task's flush, then by
   bucket; only the earliest of each goes on.  With it go the fingerprints of
   its halves: two lines within one edit share one half, so
2. only lines that share a half with a different line emit their deletion
   neighbourhood: the line less each of its words, as hashed keys.
3. Equal variants are joined.  Variants less the word of one place differ by a
   replacement, a variant equal to a whole line by a deletion; each line's
   witness is the earliest of its group, a minimum, so no pairs are enumerated.
   Both exchanges combine before they send, so no half or variant is hot: lines
   that share a half within a flush are marked there and two of them stand for
   the flush; lines that share a variant within a group have its earliest as
   their witness, and that one alone goes on.
4. The witness's text is sent to its line, the edit distance is verified on
   the words, and the earlier line is kept.

Edge cases: a null text has no lines and stays null; repeated rows of one
document have one place, so neither removes the other; rows without an id are
kept whole, with their lines counted; an empty table gives an empty one;
columns beyond doc_id and text pass through, whatever their names.

The bound is one word whatever a line's length: two lines that differ in two
words or more both stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import unused
from .scale import groups
from .stretches import MESSAGE, _batch, _dealt, _kinds
from .textcore import SPACE_WORDS, U64, Chunk, Spans, _tables, chunks, distinct, mix, split_words, tidied, unpack_all, word_hashes

MIN_WORDS = 8
FULL, HALF, DROP, ASK, VARIANT, LINK, TEXT = range(7)
_FULL = (U64, np.int64, np.int32, np.uint8)  # line, document, number, whether a different line shares a half
_HALF = (U64, U64, np.int64, np.int32)  # half, line, document, number
_PLACE = (np.int64, np.int32)
_VARIANT = (U64, np.int32, np.int64, np.int32)  # variant, place of the deleted word or -1, document, number
_LINK = (np.int64, np.int32, np.int64, np.int32)  # line, witness
FLUSH_BYTES = 16 << 20


class Lines:
    """The lines of a chunk and their words."""

    def __init__(self, c: Chunk):
        self.c, n = c, len(c)
        feeds = np.flatnonzero(c.buf == 10)
        of = np.searchsorted(c.offs, feeds, "right") - 1
        start = np.concatenate((c.offs[:-1], feeds + 1))
        doc = np.concatenate((np.arange(n), of))
        order = np.lexsort((start, doc))
        self.start, self.doc = start[order], doc[order]
        end = np.concatenate((feeds, c.offs[1:]))
        self.end = end[np.lexsort((end, np.concatenate((of, np.arange(n)))))]
        self.first = np.searchsorted(self.doc, np.arange(n + 1))
        self.number = (np.arange(len(self.doc)) - self.first[self.doc]).astype(np.int32)
        ws, we, _ = split_words(c.buf, c.offs, SPACE_WORDS)
        self.word_start, self.word_end = ws, we
        self.w0, self.w1 = np.searchsorted(ws, self.start), np.searchsorted(ws, self.end)
        self.size = self.w1 - self.w0
        self.spans = Spans(word_hashes(c.buf, ws, we))

    def hashes(self) -> np.ndarray:
        return self.spans.hash(self.w0, self.w1)

    def variants(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, place, fingerprint) of each line less each of its words; equal to the fingerprint of such a line."""
        k = self.size[line]
        of = np.repeat(line, k)
        place = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        s, e = self.w0[of], self.w1[of]
        i = s + place
        power, inverse = _tables(len(self.spans.sums) + 1)
        sums = self.spans.sums
        left = (sums[i] - sums[s]) * inverse[s]
        right = (sums[e] - sums[i + 1]) * inverse[i + 1] * power[place]
        return of, place, mix(left + right + (e - s - 1).astype(U64) * U64(0xA24BAED4963EE407))

    def words(self, line: int) -> list[bytes]:
        return self.c.buf[self.start[line] : self.end[line]].tobytes().split()


def _earliest(keys: list[np.ndarray], doc: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by keys and place: the order, and for each entry the index (in it) of its group's first."""
    order = np.lexsort((number, doc, *keys[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.empty(0, np.int64)
    return order, head


def _shared(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: whether another entry has the same, and how many entries before have it."""
    at = np.arange(len(key))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    nth = at - np.flatnonzero(new)[np.cumsum(new) - 1] if len(key) else at
    return (nth > 0) | ~np.append(new[1:], True)[: len(key)], nth


def _bucket(key: np.ndarray, g: int) -> np.ndarray:
    return (key >> U64(20)).astype(np.int64) % g


def _scan(g: int, min_words: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def halves(lines: Lines, ids: np.ndarray, hashes: np.ndarray, use: np.ndarray) -> list[np.ndarray]:
        at = use[lines.size[use] >= min_words - 1]
        s, e, n = lines.w0[at], lines.w1[at], lines.size[at]
        keys = []
        for k in (n, n - 1):
            h = k // 2
            tag = k.astype(U64) * U64(0x9E3779B97F4A7C15)
            keys += [mix(lines.spans.hash(s, s + h) + tag), mix(lines.spans.hash(e - (k - h), e) + tag + U64(1))]
        return [np.concatenate(keys), np.tile(hashes[at], 4), np.tile(ids[lines.doc[at]], 4), np.tile(lines.number[at], 4)]

    def flush(held: list[tuple]) -> pa.RecordBatch:
        full = [np.concatenate([h[0][i] for h in held]) for i in range(3)]
        half = [np.concatenate([h[1][i] for h in held]) for i in range(4)]
        order, head = _earliest(half[:2], *half[2:])
        rep = order[head == np.arange(len(head))]
        half = [x[rep] for x in half]  # different lines of each half
        shared, nth = _shared(half[0])
        marked = distinct(half[1][shared])
        order, head = _earliest(full[:1], *full[1:])
        k, d, n = (x[order] for x in full)
        late = (d != d[head]) | (n != n[head])
        rep = head == np.arange(len(head))
        near = np.isin(k[rep], marked).astype(np.uint8)
        rows = [*_dealt(DROP, d[late] % g, [d[late], n[late]]), *_dealt(FULL, _bucket(k[rep], g), [k[rep], d[rep], n[rep], near])]
        two = [x[nth < 2] for x in half]
        rows += _dealt(HALF, _bucket(two[0], g), two)
        return _batch(rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for c in chunks(batches):
            lines, ids = Lines(c), c.id_values.astype(np.int64)
            hashes = lines.hashes()
            use = np.flatnonzero(lines.size)
            held.append(([hashes[use], ids[lines.doc[use]], lines.number[use]], halves(lines, ids, hashes, use)))
            total += len(c.buf)
            if total >= FLUSH_BYTES:
                yield flush(held)
                held, total = [], 0
        if held:
            yield flush(held)

    return run


def _settle(g: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        kinds, b = _kinds(table), table.column("b")[0].as_py()
        rows = [(b, DROP, p) for p in kinds.get(DROP, [])]
        if FULL in kinds:
            k, d, n, near = unpack_all(kinds[FULL], *_FULL)
            order, head = _earliest([k], d, n)
            d, n = d[order], n[order]
            late = (d != d[head]) | (n != n[head])
            rows += _dealt(DROP, d[late] % g, [d[late], n[late]])
            first = np.unique(head[near[order] > 0])
            rows += _dealt(ASK, d[first] % g, [d[first], n[first]])
        if HALF in kinds:
            h, k, d, n = unpack_all(kinds[HALF], *_HALF)
            order, head = _earliest([h, k], d, n)
            rep = order[head == np.arange(len(head))]
            h, d, n = h[rep], d[rep], n[rep]  # different lines of each half
            near, _ = _shared(h)
            rows += _dealt(ASK, d[near] % g, [d[near], n[near]])
        return pa.Table.from_batches([_batch(rows)])

    return run


def _asked(lines: Lines, ids: np.ndarray, doc: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places that are here: their index and line (in the first of repeated rows)."""
    order = np.argsort(ids, kind="stable")
    at = np.minimum(np.searchsorted(ids[order], doc), max(0, len(ids) - 1))
    row = order[at] if len(ids) else at
    here = (ids[row] == doc) & (number < lines.first[row + 1] - lines.first[row]) if len(ids) else np.zeros(len(doc), bool)
    here = np.flatnonzero(here)
    return here, lines.first[row[here]] + number[here]


def _emit(g: int, min_words: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        rows = [(int(table.column("b")[0].as_py()), DROP, p) for p in kinds.get(DROP, [])]
        doc, number = unpack_all(kinds.get(ASK, []), *_PLACE)
        if len(doc):
            doc, number = np.unique(np.stack([doc, number.astype(np.int64)]), axis=1)
            held = []
            for c in chunks(docs.to_batches()):
                lines, ids = Lines(c), c.id_values.astype(np.int64)
                here, line = _asked(lines, ids, doc, number)
                if not len(line):
                    continue
                long = line[lines.size[line] >= min_words]
                of, place, key = lines.variants(long)
                keys = np.concatenate((key, lines.hashes()[line]))
                places = np.concatenate((place, np.full(len(line), -1))).astype(np.int32)
                of = np.concatenate((of, line))
                held.append([keys, places, ids[lines.doc[of]], lines.number[of]])
            if held:
                k, place, d, n = (np.concatenate(x) for x in zip(*held, strict=True))
                order, head = _earliest([k, place], d, n)
                k, place, d, n = k[order], place[order], d[order], n[order]
                v = np.flatnonzero((place >= 0) & ((d != d[head]) | (n != n[head])))
                rows += _dealt(LINK, d[head[v]] % g, [d[v], n[v], d[head[v]], n[head[v]]])
                rep = head == np.arange(len(head))
                rows += _dealt(VARIANT, _bucket(k[rep], g), [k[rep], place[rep], d[rep], n[rep]])
        return pa.Table.from_batches([_batch(rows)])

    return run


def _join(g: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        kinds, b = _kinds(table), table.column("b")[0].as_py()
        rows = [(b, kind, p) for kind in (DROP, LINK) for p in kinds.get(kind, [])]
        if VARIANT in kinds:
            k, place, d, n = unpack_all(kinds[VARIANT], *_VARIANT)
            order, head = _earliest([k, place], d, n)
            k, place, d, n = k[order], place[order], d[order], n[order]
            victim, witness = [], []
            same = np.flatnonzero((place >= 0) & ((d != d[head]) | (n != n[head])))  # one word replaced
            victim.append(same)
            witness.append(head[same])
            # a whole line (place -1 comes first in its key) against longer lines less one word
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(k) else head
            whole = place[first] == -1
            longer = np.flatnonzero(whole & (place >= 0))
            victim.append(longer)
            witness.append(first[longer])
            best = longer[np.lexsort((n[longer], d[longer], first[longer]))]
            best = best[np.concatenate(([True], first[best][1:] != first[best][:-1]))] if len(best) else best
            victim.append(first[best])
            witness.append(best)
            v, w = np.concatenate(victim), np.concatenate(witness)
            later = (d[w] < d[v]) | ((d[w] == d[v]) & (n[w] < n[v]))
            v, w = v[later], w[later]
            rows += _dealt(LINK, d[w] % g, [d[v], n[v], d[w], n[w]])
        return pa.Table.from_batches([_batch(rows)])

    return run


def _send(g: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        rows = [(int(table.column("b")[0].as_py()), DROP, p) for p in kinds.get(DROP, [])]
        vd, vn, wd, wn = unpack_all(kinds.get(LINK, []), *_LINK)
        # one witness (the earliest) for each line from this group
        order = np.lexsort((wn, wd, vn, vd))
        vd, vn, wd, wn = vd[order], vn[order], wd[order], wn[order]
        new = np.ones(len(vd), bool)
        new[1:] = (vd[1:] != vd[:-1]) | (vn[1:] != vn[:-1])
        vd, vn, wd, wn = vd[new], vn[new], wd[new], wn[new]
        for c in chunks(docs.to_batches()) if len(vd) else ():
            lines = Lines(c)
            here, line = _asked(lines, c.id_values.astype(np.int64), wd, wn)
            to = vd[here] % g
            order = np.lexsort((line, to))  # a witness's text goes once to each group
            cut = np.flatnonzero((np.diff(line[order]) != 0) | (np.diff(to[order]) != 0)) + 1
            for part in np.split(order, cut):
                if len(part):
                    at, k = int(line[part[0]]), here[part]
                    text = c.buf[lines.start[at] : lines.end[at]].tobytes()
                    rows.append((int(to[part[0]]), TEXT, len(part).to_bytes(8, "little") + vd[k].tobytes() + vn[k].astype(np.int32).tobytes() + text))
        return pa.Table.from_batches([_batch(rows)])

    return run


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether the edit distance of two word sequences is one at most."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    return (a[i + 1 :] == b[i:]) if len(a) > len(b) else (a[i:] == b[i + 1 :])


def drop_lines(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their own columns, text less the removed lines, and n_lines and n_removed (with leading underscores if taken)."""
    g = groups(docs)
    n_lines, n_removed, group = (unused(x, docs.columns) for x in ("n_lines", "n_removed", "line_group"))
    kept = docs.withColumns({"text": F.col("text").cast("string"), n_lines: F.lit(0).cast("long"), n_removed: F.lit(0).cast("long")})
    dealt = kept.where("doc_id is not null").withColumn(group, F.pmod(F.col("doc_id").cast("long"), F.lit(g)))
    rows = kept.where("doc_id is not null").select("doc_id", "text")

    def cogrouped(m: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: object = MESSAGE) -> DataFrame:
        return dealt.groupBy(group).cogroup(m.groupBy("b")).applyInArrow(run, schema)

    m = rows.mapInArrow(tidied(_scan(g, min_words)), MESSAGE)
    m = m.groupBy("b").applyInArrow(_settle(g), MESSAGE)
    m = cogrouped(m, _emit(g, min_words))
    m = m.groupBy("b").applyInArrow(_join(g), MESSAGE)
    m = cogrouped(m, _send(g))

    def finish(table: pa.Table, messages: pa.Table) -> pa.Table:
        kinds = _kinds(messages)
        doc, number = unpack_all(kinds.get(DROP, []), *_PLACE)
        near = _Witnesses(kinds.get(TEXT, []))
        table = table.drop_columns([group])
        out = []
        for c in chunks(table.select(["doc_id", "text"]).to_batches()):
            out.append(_cut(c, doc, number, near))
        texts, total, removed = (np.concatenate([o[i] for o in out]) if out else np.empty(0) for i in range(3))
        null = table.column("text").is_null().to_numpy() if table.num_rows else np.empty(0, bool)
        fields = table.schema
        new = {"text": pa.array(texts.tolist(), pa.binary(), mask=null).cast(fields.field("text").type), n_lines: pa.array(total.astype(np.int64)), n_removed: pa.array(removed.astype(np.int64))}
        for k, v in new.items():
            table = table.set_column(fields.get_field_index(k), k, v)
        return table

    out = cogrouped(m, finish, kept.schema)
    nameless = kept.where("doc_id is null").withColumn(n_lines, F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0).cast("long"))
    return out.unionByName(nameless)


class _Witnesses:
    """The lines that have witnesses, flat, and the witnesses' words."""

    def __init__(self, payloads: list[bytes]):
        size = [int.from_bytes(p[:8], "little") for p in payloads]
        self.doc = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(p, np.int64, k, 8) for p, k in zip(payloads, size, strict=True))])
        self.number = np.concatenate([np.empty(0, np.int32), *(np.frombuffer(p, np.int32, k, 8 + 8 * k) for p, k in zip(payloads, size, strict=True))])
        self.of = np.repeat(np.arange(len(size)), size)
        self.words = [p[8 + 12 * k :].split() for p, k in zip(payloads, size, strict=True)]


def _cut(c: Chunk, doc: np.ndarray, number: np.ndarray, near: _Witnesses) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lines, ids = Lines(c), c.id_values.astype(np.int64)
    gone = np.zeros(len(lines.doc), bool)
    place = {}
    for i, d in enumerate(ids.tolist()):
        place.setdefault(d, []).append(i)
    repeated = any(len(x) > 1 for x in place.values())
    here, line = _asked(lines, ids, doc, number)
    gone[line] = True
    here, line = _asked(lines, ids, near.doc, near.number)
    for at, of in zip(line.tolist(), near.of[here].tolist(), strict=True):
        if not gone[at] and within_one(lines.words(at), near.words[of]):
            gone[at] = True
    if repeated:  # rows of one document are alike
        for x in place.values():
            for other in x[1:]:
                n = min(lines.first[other + 1] - lines.first[other], lines.first[x[0] + 1] - lines.first[x[0]])
                gone[lines.first[other] : lines.first[other] + n] = gone[lines.first[x[0]] : lines.first[x[0]] + n]
    raw = c.buf.tobytes()
    first, s, e = lines.first.tolist(), lines.start.tolist(), lines.end.tolist()
    texts = np.empty(len(c), object)
    removed = np.zeros(len(c), np.int64)
    for i in range(len(c)):
        a, b = first[i], first[i + 1]
        cut = gone[a:b]
        removed[i] = cut.sum()
        texts[i] = raw[c.offs[i] : c.offs[i + 1]] if not removed[i] else b"\n".join(raw[s[j] : e[j]] for j in range(a, b) if not gone[j])
    total = np.diff(lines.first) * (np.diff(c.offs) > 0)
    return texts, total.astype(np.int64), removed


def digests(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) of every row; an empty text has no lines."""
    out = drop_lines(docs.select("doc_id", "text"), min_words=min_words)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


__all__ = ["digests", "drop_lines", "within_one"]
