"""Jaccard join of word n-gram sets, size-aware: small sets are light, large sets heavy.

Two documents link when their sets of distinct ``n``-word shingles have a
Jaccard similarity of ``percent`` / 100 or more; components of links are
returned.  Documents with one set are one class and only its smallest id takes
part further.

* Light sets (few shingles) enumerate all their subsets of the fixed size that
  a partner's size asks for: sets with a common subset are linked.  The boundary
  between light and heavy is the size with the least total cost, from the
  corpus' own size histogram.
* Heavy sets scan inverted lists.  Tokens have one global order (tokens that a
  sketch of the corpus shows to be frequent come last, else by fingerprint);
  linked sets share a token among their first n - ceil(0.75 n) + 1, so only
  these are listed.  The number of listed tokens that a pair shares bounds its
  overlap; the pairs that it leaves are verified on whole sets.

Large groups of near copies are first contracted: documents that share a
minimum token are verified against the smallest of them, in each task's rows and
then over all.  A verified document points to it, pointers are followed twice
(document, its task's smallest, the smallest of all), and documents with one
leader are in one component already: their pairs are not listed again.  No pair is capped or dropped.  All exchanges are packed arrays
keyed by document group or by token bucket, whose numbers grow with the input.

Fingerprints have 64 bits.

Edge cases: words are split at ASCII white space, A-Z lower-cased; a text of
fewer words than ``n`` is one shingle; a null or empty text has none and links
with nothing; repeated rows of one id are one document, returned as often;
rows without an id have a null component; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .lm_score import summed
from .scale import checkpoint_dir, groups
from .stretches import MESSAGE, _batch, _dealt, _kinds
from .textcore import LOWER, SPACE_WORDS, U64, Chunk, Spans, chunks, mix, owner, pack, split_words, tidied, unpack_all, windows, word_hashes

SKETCH_BITS = 20
SIZES = 64  # sizes counted for the boundary
NODE, EDGE, COPY, SAME, LIGHT, LEAST, PAIR, SETS, LISTED, COUNTED, POINT, ASKED, TOLD = range(13)
_PAIR = (np.int64, np.int64)
_KEYED = (U64, np.int64, np.int32, np.int32)  # key, document, size, role
_LISTED = (U64, np.int64, np.int64, np.int32)  # token, document, leader, size
_COUNTED = (np.int64, np.int64, np.int32, np.int32, np.int32)  # pair, shared, sizes
FLUSH_BYTES = 16 << 20
_STARS = 4
_CENTRES = 3
_REST = 64


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int = 75) -> np.ndarray | int:
    """The smallest overlap of linked sets of these sizes."""
    return -(-(percent * (a + b)) // (100 + percent))


def prefix(n: np.ndarray, percent: int = 75) -> np.ndarray:
    return n - -(-(percent * n) // 100) + 1


def shingles(c: Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints, sorted in each document, and each document's first."""
    buf = LOWER[c.buf]
    starts, ends, first = split_words(buf, c.offs, SPACE_WORDS)
    hashes = word_hashes(buf, starts, ends)
    h, at = windows(hashes, first, n)
    size = np.diff(first)
    short = np.flatnonzero((size > 0) & (size < n))
    of = owner(first)[at]
    if len(short):
        h = np.concatenate((h, Spans(hashes).hash(first[short], first[short + 1])))
        of = np.concatenate((of, short))
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return h[new], np.searchsorted(of[new], np.arange(len(c) + 1))


def _part(c: Chunk, wanted: np.ndarray) -> Chunk:
    """The chunk's rows with these ids (one of repeated ones)."""
    ids = c.id_values
    _, row = np.unique(ids, return_index=True)
    row = row[np.isin(ids[row], wanted)]
    size = c.offs[row + 1] - c.offs[row]
    ends = np.cumsum(size)
    at = np.repeat(c.offs[row] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return Chunk(c.ids.take(pa.array(row)), c.buf[at], np.concatenate(([0], ends)))


def _sketch(c: Chunk, n: int) -> np.ndarray:
    h, first = shingles(c, n)
    return np.concatenate((np.bincount((h >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS), np.bincount(np.minimum(np.diff(first), SIZES - 1), minlength=SIZES)))


def light_keys(n: int, boundary: int, percent: int = 75) -> list[tuple[int, int]]:
    """(partner size, subset size) for a light set of n shingles."""
    return [(m, needed(n, m, percent)) for m in range(1, boundary + 1) if needed(n, m, percent) <= min(n, m)]


def boundary(sizes: np.ndarray, percent: int = 75, unit: int = 16) -> int:
    """The largest light size, by least cost: subsets of light sets against listed tokens (``unit`` each) of the others."""
    best = (float("inf"), 0)
    for x in range(13):
        light = sum(int(sizes[n]) * sum(comb(n, k) for _, k in light_keys(n, x, percent)) for n in range(1, x + 1))
        heavy = sum(int(sizes[n]) * unit * int(prefix(np.int64(n), percent)) for n in range(1, SIZES - 1) if 100 * n >= percent * (x + 1))
        best = min(best, (light + heavy, x))
    return best[1]


class Plan:
    """What all tasks share: a fixed size."""

    def __init__(self, table: np.ndarray, n: int, percent: int, g: int):
        counts, sizes = table[: 1 << SKETCH_BITS], table[1 << SKETCH_BITS :]
        mean = counts.mean()
        self.hot = counts > mean + max(64.0, 8 * mean**0.5)
        self.n, self.percent, self.g = n, percent, g
        self.boundary = boundary(sizes, percent)

    def order(self, h: np.ndarray) -> np.ndarray:
        """Keys of the global token order."""
        return (h >> U64(1)) | (self.hot[(h >> U64(64 - SKETCH_BITS)).astype(np.int64)].astype(U64) << U64(63))

    def bucket(self, key: np.ndarray) -> np.ndarray:
        return (mix(key) >> U64(20)).astype(np.int64) % self.g


def _star(key: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by key and document: the order, and for each entry the index (in it) of its group's first."""
    order = np.lexsort((columns[0], key))
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(k) else np.empty(0, np.int64)
    return order, head


def _group(table: pa.Table) -> int:
    return int(table.column("b")[0].as_py()) if table.num_rows else 0


def _passed(kinds: dict[int, list[bytes]], b: int, which: tuple[int, ...]) -> list[tuple[int, int, bytes]]:
    """Messages for the same group, one row for each kind."""
    return [(b, k, pack(*unpack_all(kinds[k], *_PAIR))) for k in which if k in kinds]


def _similar_size(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _linked(h: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets a and b (rows of sorted fingerprints) link."""
    out = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        own, other = h[first[x] : first[x + 1]], h[first[y] : first[y + 1]]
        at = np.minimum(np.searchsorted(own, other), len(own) - 1)
        out[i] = int((own[at] == other).sum()) >= needed(len(own), len(other), percent)
    return out


def _near(plan: Plan, keys: np.ndarray, reps: np.ndarray, ids: np.ndarray, h: np.ndarray, size: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Stars within a flush: keys and rows to compare over all, and the links found (centre, row).

    Rows of one key are verified against the smallest; those that do not link
    form the next star.  The centres of the first ``_CENTRES`` stars of a key are
    passed on with ``_REST`` of the rows left, so a frequent key costs a bounded
    number of rows for each flush.  Rows that are not passed on have no pointer
    and are compared in the lists like all others.
    """
    first = np.concatenate(([0], np.cumsum(size)))
    free = np.zeros(len(ids), bool)
    free[reps[size[reps] > plan.boundary]] = True
    out_key, out_row, out_a, out_b = [np.empty(0, U64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for key in keys:
        row = np.flatnonzero(free)
        for _ in range(_CENTRES):
            order, head = _star(key[row], [ids[row]])
            row, centre = row[order], row[order][head]
            alone = row == centre
            out_key.append(key[row[alone]])
            out_row.append(row[alone])
            row, centre = row[~alone], centre[~alone]
            link = _similar_size(size[row], size[centre], plan.percent)
            link[link] = _linked(h, first, centre[link], row[link], plan.percent)
            out_a.append(centre[link])
            out_b.append(row[link])
            free[row[link]] = False
            row = row[~link]
        order, head = _star(key[row], [ids[row]])
        rest = row[order][np.arange(len(row)) - head < _REST]
        out_key.append(key[rest])
        out_row.append(rest)
    return (np.concatenate(out_key), np.concatenate(out_row)), (np.concatenate(out_a), np.concatenate(out_b))


def _first(plan: Plan) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    g, percent = plan.g, plan.percent

    def flush(held: list[tuple]) -> pa.RecordBatch:
        rows: list = []
        ids, size, same = (np.concatenate([h[i] for h in held]) for i in range(3))
        rows += _dealt(NODE, ids % g, [ids, size.astype(np.int64)])
        some = np.flatnonzero(size)
        order, head = _star(same[some], [ids[some]])
        at = some[order]
        d, k, z = ids[at], same[at], size[at]
        copy = d != d[head]
        rows += _dealt(EDGE, d[copy] % g, [d[copy], d[head][copy]])
        rows += _dealt(COPY, d[copy] % g, [d[copy], d[head][copy]])
        rep = head == np.arange(len(head))
        rows += _dealt(SAME, plan.bucket(k[rep]), [k[rep], d[rep], z[rep].astype(np.int32), np.zeros(rep.sum(), np.int32)])
        light = [np.concatenate([x[3][i] for x in held]) for i in range(4)]
        rows += _dealt(LIGHT, plan.bucket(light[0]), light)
        (key, row), (a, b) = _near(plan, np.concatenate([x[4] for x in held], axis=1), at[rep], ids, np.concatenate([x[5] for x in held]), size)
        for kind in (EDGE, POINT):
            rows += _dealt(kind, ids[b] % g, [ids[b], ids[a]])
        rows += _dealt(LEAST, plan.bucket(key), [key, ids[row], size[row].astype(np.int32), np.zeros(len(row), np.int32)])
        return _batch(rows)

    def scan(c: Chunk) -> tuple:
        h, first = shingles(c, plan.n)
        ids, size, of = c.id_values.astype(np.int64), np.diff(first), owner(first)
        same = np.zeros(len(c), U64)
        some = np.flatnonzero(size)
        if len(some):
            same[some] = mix(np.add.reduceat(mix(h), first[:-1][some]) + size[some].astype(U64))
        light = [np.empty(0, t) for t in _KEYED]
        keys: list[tuple] = []
        for i in np.flatnonzero((size > 0) & (size <= plan.boundary)).tolist():
            own, m = [int(x) for x in mix(h[first[i] : first[i + 1]])], int(size[i])
            for partner, k in light_keys(m, plan.boundary, percent):
                tag = (min(m, partner) * 1000003 + max(m, partner)) * 0x9E3779B97F4A7C15
                keys += [((sum(s) + tag) & 0xFFFFFFFFFFFFFFFF, int(ids[i]), m, (m > partner) - (m < partner)) for s in combinations(own, k)]
        if keys:
            light = [np.array([k[j] for k in keys], t) for j, t in enumerate(_KEYED)]
            light[0] = mix(light[0])
        # minimum tokens under several hashes; frequent ones too, for those of a large group of near copies are frequent
        least = np.zeros((_STARS, len(c)), U64)
        if len(some):
            for j in range(_STARS):
                least[j, some] = mix(np.minimum.reduceat(mix(h + U64(j * 7919 + 1)), first[:-1][some]) + U64(j))
        return ids, size, same, light, least, h

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for c in chunks(batches):
            held.append(scan(c))
            total += len(c.buf)
            if total >= FLUSH_BYTES:
                yield flush(held)
                held, total = [], 0
        if held:
            yield flush(held)

    return run


def _by_key(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    """Copies, light links and stars of one bucket of keys."""
    g = plan.g

    def run(table: pa.Table) -> pa.Table:
        kinds, b = _kinds(table), table.column("b")[0].as_py()
        rows = _passed(kinds, b, (NODE, EDGE, COPY, PAIR, POINT))
        if SAME in kinds:
            k, d, *_ = unpack_all(kinds[SAME], *_KEYED)
            order, head = _star(k, [d])
            d = d[order]
            copy = d != d[head]
            for kind in (EDGE, COPY):
                rows += _dealt(kind, d[copy] % g, [d[copy], d[head][copy]])
        if LIGHT in kinds:
            k, d, n, role = unpack_all(kinds[LIGHT], *_KEYED)
            # equal sizes link to their first; of two sizes each side links to the other's first
            order = np.lexsort((d, role, k))
            k, d, role = k[order], d[order], role[order]
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            at = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            side = np.ones(len(k), bool)
            side[1:] = new[1:] | (role[1:] != role[:-1])
            heads = np.flatnonzero(side)
            last_side = heads[np.searchsorted(heads, np.append(at[1:], len(k)) - 1, "right") - 1]
            other = np.where(role > 0, at[group], np.where(role < 0, last_side[group], at[group]))
            link = (d != d[other]) & ((role == 0) | (role != role[other]))
            rows += _dealt(EDGE, d[link] % g, [d[link], d[other][link]])
        if LEAST in kinds:
            k, d, n, _ = unpack_all(kinds[LEAST], *_KEYED)
            order, head = _star(k, [d])
            d, n = d[order], n[order]
            link = (d != d[head]) & _similar_size(n, n[head], plan.percent)
            rows += _dealt(PAIR, d[head][link] % g, [d[head][link], d[link]])
        return pa.Table.from_batches([_batch(rows)])

    return run


def _send(docs: pa.Table, a: np.ndarray, b: np.ndarray, plan: Plan) -> Iterator[tuple[int, int, bytes]]:
    """The set of each ``a`` to the groups of its ``b``s, once to each group."""
    if not len(a):
        return
    pairs = np.unique(np.stack([a, b % plan.g, b]), axis=1)
    a, to, b = pairs
    for c in chunks(docs.to_batches()):
        p = _part(c, a)
        if not len(p):
            continue
        h, first = shingles(p, plan.n)
        for i, doc in enumerate(p.id_values.tolist()):
            lo, hi = np.searchsorted(a, doc), np.searchsorted(a, doc, "right")
            own = h[first[i] : first[i + 1]]
            cut = np.flatnonzero(np.diff(to[lo:hi])) + 1
            for x in np.split(np.arange(lo, hi), cut):
                yield int(to[x[0]]), SETS, np.array([doc, len(x), len(own)], np.int64).tobytes() + b[x].tobytes() + own.tobytes()


def _verify(sets: dict[int, np.ndarray], payloads: list[bytes], percent: int) -> list[np.ndarray]:
    """Linked pairs of the messages' sets with sets at hand."""
    out_a, out_b = [], []
    for p in payloads:
        doc, nb, na = np.frombuffer(p, np.int64, 3).tolist()
        bs, own = np.frombuffer(p, np.int64, nb, 24), np.frombuffer(p, U64, na, 24 + 8 * nb)
        for b in bs.tolist():
            other = sets.get(b)
            if other is None or b == doc:
                continue
            at = np.minimum(np.searchsorted(own, other), na - 1)
            if int((own[at] == other).sum()) >= needed(na, len(other), percent):
                out_a.append(doc)
                out_b.append(b)
    return [np.array(out_a, np.int64), np.array(out_b, np.int64)]


def _targets(payloads: list[bytes]) -> np.ndarray:
    parts = [np.frombuffer(p, np.int64, int(np.frombuffer(p, np.int64, 1, 8)[0]), 24) for p in payloads]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)


def _ask_stars(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        rows = _passed(kinds, _group(table), (NODE, EDGE, COPY, POINT))
        rows += _send(docs, *unpack_all(kinds.get(PAIR, []), *_PAIR), plan)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _asked(doc: np.ndarray, leader: np.ndarray, b: int, g: int) -> list[tuple[int, int, bytes]]:
    """Pointers, kept in their group, and questions to the groups of their leaders, once for each."""
    if not len(doc):
        return []
    to = np.unique(leader)
    return [(b, POINT, pack(doc, leader)), *_dealt(ASKED, to % g, [to, np.full(len(to), b, np.int64)])]


def _moved(value: np.ndarray, kinds: dict[int, list[bytes]], kind: int) -> np.ndarray:
    """Values replaced by what the messages of this kind (value, new value) say."""
    old, new = unpack_all(kinds.get(kind, []), *_PAIR)
    if not len(old):
        return value
    order = np.argsort(old, kind="stable")
    old, new = old[order], new[order]
    at = np.minimum(np.searchsorted(old, value), len(old) - 1)
    return np.where(old[at] == value, new[at], value)


def _verify_stars(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Links of stars; each document linked to a centre points to the smallest of them."""

    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        kinds, here = _kinds(table), _group(table)
        rows = _passed(kinds, here, (NODE, EDGE, COPY))
        wanted = _targets(kinds.get(SETS, []))
        found = [unpack_all(kinds.get(POINT, []), *_PAIR)]
        for c in chunks(docs.to_batches()) if len(wanted) else ():
            p = _part(c, wanted)
            h, first = shingles(p, plan.n)
            sets = {d: h[first[i] : first[i + 1]] for i, d in enumerate(p.id_values.tolist())}
            a, b = _verify(sets, kinds[SETS], plan.percent)
            rows += _dealt(EDGE, b % plan.g, [b, a])
            found.append([b, a])
        b, a = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((a, b))
        own, at = np.unique(b[order], return_index=True)
        rows += _asked(own, a[order][at], here, plan.g)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _answer(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    """Tells the groups that asked where the leaders themselves point."""

    def run(table: pa.Table) -> pa.Table:
        kinds, b = _kinds(table), _group(table)
        rows = _passed(kinds, b, (NODE, EDGE, COPY, POINT))
        who, to = unpack_all(kinds.get(ASKED, []), *_PAIR)
        points = _moved(who, kinds, POINT)
        use = points != who
        rows += _dealt(TOLD, to[use], [who[use], points[use]])
        return pa.Table.from_batches([_batch(rows)])

    return run


def _follow(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    """Moves pointers on to their leaders' leaders and asks again."""

    def run(table: pa.Table) -> pa.Table:
        kinds, b = _kinds(table), _group(table)
        doc, leader = unpack_all(kinds.get(POINT, []), *_PAIR)
        rows = _passed(kinds, b, (NODE, EDGE, COPY)) + _asked(doc, _moved(leader, kinds, TOLD), b, plan.g)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _list_prefixes(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Lists the first tokens of all sets with their leaders."""
    g, percent = plan.g, plan.percent

    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        rows = _passed(kinds, _group(table), (NODE, EDGE))
        copies = np.unique(unpack_all(kinds.get(COPY, []), *_PAIR)[0])
        listed: list[list[np.ndarray]] = []
        for c in chunks(docs.to_batches()):
            p = _part(c, c.id_values)
            h, first = shingles(p, plan.n)
            ids, size = p.id_values.astype(np.int64), np.diff(first)
            leader = _moved(_moved(ids, kinds, POINT), kinds, TOLD)
            use = (100 * size >= percent * (plan.boundary + 1)) & (size > 0) & ~np.isin(ids, copies)
            key = plan.order(h)
            of = owner(first)
            order = np.lexsort((key, of))
            rank = np.arange(len(h)) - first[of]
            take = use[of] & (rank < prefix(size, percent)[of])
            d = of[take]
            listed.append([h[order][take], ids[d], leader[d], size[d].astype(np.int32)])
        if listed:
            cols = [np.concatenate(x) for x in zip(*listed, strict=True)]
            rows += _dealt(LISTED, plan.bucket(cols[0]), cols)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _counted(token: np.ndarray, doc: np.ndarray, leader: np.ndarray, size: np.ndarray, plan: Plan, slice_pairs: int = 2_000_000) -> Iterator[list[np.ndarray]]:
    """Pairs of different leaders in one list, with the number of lists that hold them."""
    order = np.argsort(token, kind="stable")
    t = token[order]
    new = np.ones(len(t), bool)
    new[1:] = t[1:] != t[:-1]
    at = np.flatnonzero(new)
    many = np.repeat(np.diff(np.append(at, len(t))) > 1, np.diff(np.append(at, len(t)))) if len(t) else new
    order = order[many]
    order = order[np.lexsort((doc[order], leader[order], token[order]))]
    t, d, ld, n = token[order], doc[order], leader[order], size[order].astype(np.int64)
    if not len(t):
        return
    index = np.arange(len(t))
    list_end = np.searchsorted(index[np.append(t[1:] != t[:-1], True)], index)
    list_end = index[np.append(t[1:] != t[:-1], True)][list_end] + 1
    edge = np.append((t[1:] != t[:-1]) | (ld[1:] != ld[:-1]), True)
    run_end = index[edge][np.searchsorted(index[edge], index)] + 1
    count = list_end - run_end  # partners of other leaders, further on
    total = np.cumsum(count)
    start = 0
    while start < len(t):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + slice_pairs, "right")))
        k = count[start:stop]
        i = np.repeat(index[start:stop], k)
        j = np.repeat(run_end[start:stop] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        ok = _similar_size(n[i], n[j], plan.percent) & (d[i] != d[j]) & ((n[i] > plan.boundary) | (n[j] > plan.boundary))
        i, j = i[ok], j[ok]
        swap = d[i] > d[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        yield _united([d[i], d[j], np.ones(len(i), np.int32), n[i].astype(np.int32), n[j].astype(np.int32)])
        start = stop


def _united(p: list[np.ndarray]) -> list[np.ndarray]:
    order = np.lexsort((p[1], p[0]))
    p = [x[order] for x in p]
    if not len(order):
        return p
    new = np.ones(len(order), bool)
    new[1:] = (p[0][1:] != p[0][:-1]) | (p[1][1:] != p[1][:-1])
    at = np.flatnonzero(new)
    return [p[0][at], p[1][at], np.add.reduceat(p[2], at).astype(np.int32), p[3][at], p[4][at]]


def _scan_lists(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        kinds, b = _kinds(table), table.column("b")[0].as_py()
        rows = _passed(kinds, b, (NODE, EDGE))
        if LISTED in kinds:
            for p in _counted(*unpack_all(kinds[LISTED], *_LISTED), plan):
                rows += _dealt(COUNTED, p[0] % plan.g, p)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _ask_pairs(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        rows = _passed(kinds, _group(table), (NODE, EDGE))
        a, b, shared, na, nb = (x.astype(np.int64) for x in _united(unpack_all(kinds.get(COUNTED, []), *_COUNTED)))
        most = shared + np.maximum(na - prefix(na, plan.percent), nb - prefix(nb, plan.percent))
        may = most >= needed(na, nb, plan.percent)
        rows += _send(docs, a[may], b[may], plan)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _link_pairs(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        rows = _passed(kinds, _group(table), (NODE, EDGE))
        wanted = _targets(kinds.get(SETS, []))
        for c in chunks(docs.to_batches()) if len(wanted) else ():
            p = _part(c, wanted)
            h, first = shingles(p, plan.n)
            sets = {d: h[first[i] : first[i + 1]] for i, d in enumerate(p.id_values.tolist())}
            a, b = _verify(sets, kinds[SETS], plan.percent)
            rows += _dealt(EDGE, b % plan.g, [b, a])
        return pa.Table.from_batches([_batch(rows)])

    return run


def _decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = unpack_all(batch.column("payload").to_pylist(), *_PAIR)
        yield pa.RecordBatch.from_pydict({"a": a, "b": b})


def join_components(docs: DataFrame, *, n: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; the component is the smallest id reachable by links."""
    checkpoint_dir(docs.sparkSession)
    g = groups(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = rows.where("doc_id is not null")
    sent = docs.sparkSession.sparkContext.broadcast(Plan(summed(named, (1 << SKETCH_BITS) + SIZES, lambda c: _sketch(c, n)), n, percent, g))  # about 1 MB

    def lazily(make: Callable) -> Callable:
        return lambda *a: make(sent.value)(*a)

    def grouped(make: Callable) -> Callable[[pa.Table], pa.Table]:
        return lambda t: make(sent.value)(t)

    def cogrouped(make: Callable) -> Callable[[pa.Table, pa.Table], pa.Table]:
        return lambda x, y: make(sent.value)(x, y)

    dealt = named.withColumn("b", F.pmod("doc_id", F.lit(g)))
    m = named.mapInArrow(tidied(lazily(_first)), MESSAGE)
    m = m.groupBy("b").applyInArrow(grouped(_by_key), MESSAGE)
    m = dealt.groupBy("b").cogroup(m.groupBy("b")).applyInArrow(cogrouped(_ask_stars), MESSAGE)
    m = dealt.groupBy("b").cogroup(m.groupBy("b")).applyInArrow(cogrouped(_verify_stars), MESSAGE)
    for step in (_answer, _follow, _answer):
        m = m.groupBy("b").applyInArrow(grouped(step), MESSAGE)
    m = dealt.groupBy("b").cogroup(m.groupBy("b")).applyInArrow(cogrouped(_list_prefixes), MESSAGE)
    m = m.groupBy("b").applyInArrow(grouped(_scan_lists), MESSAGE)
    m = dealt.groupBy("b").cogroup(m.groupBy("b")).applyInArrow(cogrouped(_ask_pairs), MESSAGE)
    m = dealt.groupBy("b").cogroup(m.groupBy("b")).applyInArrow(cogrouped(_link_pairs), MESSAGE)
    done = m.where(F.col("kind").isin(NODE, EDGE)).checkpoint()  # nodes and links: 16 bytes each
    nodes = done.where(F.col("kind") == NODE).mapInArrow(_decoded, "a long, b long").select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"))
    links = done.where(F.col("kind") == EDGE).mapInArrow(_decoded, "a long, b long")
    comp = connected(links)
    out = nodes.join(comp, nodes["doc_id"] == comp["node"], "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))

    def nameless(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": c.ids.cast(pa.int64()), "n_shingles": np.diff(shingles(c, n)[1]).astype(np.int64), "component_id": pa.nulls(len(c), pa.int64())})

    return out.unionByName(rows.where("doc_id is null").mapInArrow(nameless, "doc_id long, n_shingles long, component_id long"))


def keep_one(docs: DataFrame, *, n: int = 5, percent: int = 75) -> DataFrame:
    """The documents with the smallest id of their component (and those without an id), with their own columns."""
    c = join_components(docs, n=n, percent=percent).where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    kept = docs.join(c, docs["doc_id"] == c["_kept"], "left_semi")
    return kept.unionByName(docs.where("doc_id is null"))


__all__ = ["boundary", "join_components", "keep_one", "light_keys", "needed", "prefix", "shingles"]
