"""Masked pseudo-likelihood scores from a bidirectional window network and counts of word pairs.

Every token is predicted from both sides, from a window of two words each way.
A network with one hidden layer reads the kinds of these four words and gives the
distribution of the masked token's class; times the token's share of its class
this is a first distribution of the token itself.  Counts of the pairs that the
token makes with its two neighbours then condition it on the neighbours' words:

    (pairs with the left word + pairs with the right word + weight * first)
    / (places + weight),    weight = PRIOR + SPREAD * places ** GROWTH

with the places of the left and the right word: frequent words have many different
neighbours, so what they have not met yet counts for more.

A document's score is the sum of the logarithms over all its tokens.  Where the
documents scored are those counted, a token's own place is taken out of each
count, so a rare pair says nothing for itself but only for its repeats.

The most frequent words have a class of their own; others belong to the class of
their shape (first and last letters and length).  Shapes with like neighbours
among the frequent words form a class, so classes tell languages and registers
apart, and a word never seen has one too.  Kinds are unions of like classes.

Shapes' neighbours and classes in their windows are counted over all tokens, in
tables of a fixed size that are added up in a tree; the network learns from these.  Words and pairs have one count each, however many there are:
documents are dealt to groups, a group sends its distinct keys with their counts
to those buckets of the key space that it has keys of, a bucket adds them up and
answers in the order of the keys, and each group scores its documents with the
answers.  What is gathered grows with the corpus, and none of it passes the
driver.  Keys are hashes of 56 bits with the class in 8 more.

Edge cases: a text without words has no tokens, a score of 0 and a null mean;
repeated rows count each and are scored each; an empty table gives an empty
one; ids may be null.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scale import GROUP_BYTES, groups
from .textcore import LOWER, SPACE_WORDS, U64, Chunk, chunks, distinct, mix, numbered, owner, split_words, tidied, word_hashes

BUCKET_BITS = 17
CLASSES = 96  # class 0 is the text's edge
_SINGLE = 64  # frequent buckets with a class of their own
SHAPE_BITS = 13
# weight of the network's distribution, in places
PRIOR = 4.0
SPREAD = 3.0
GROWTH = 0.9
KINDS = 12  # kind 0 is beyond the text's edge
REACH = (1, 2)  # distances of the words that the network reads, to both sides
_MESSAGE = "g long, p long, keys binary, counts binary"
#: Text bytes whose distinct words are sent at once.
FLUSH_BYTES = 16 << 20
#: Tables that one task adds up.
_TREE = 16


def _tokens(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of each word, and each document's first word."""
    buf = LOWER[c.buf]
    starts, ends, first = split_words(buf, c.offs, SPACE_WORDS)
    if not len(starts):
        return np.empty(0, U64), np.empty(0, np.int64), first
    size = ends - starts
    parts = (buf[starts], np.where(size > 1, buf[np.minimum(starts + 1, len(buf) - 1)], 0), np.where(size > 2, buf[ends - 2], 0), buf[ends - 1], np.minimum(size, 12))
    shape = np.zeros(len(starts), U64)
    for x in parts:
        shape = shape * U64(256) + x.astype(U64)
    return word_hashes(buf, starts, ends), (mix(shape) >> U64(64 - SHAPE_BITS)).astype(np.int64), first


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> U64(64 - BUCKET_BITS)).astype(np.int64)


def _sides(classes: np.ndarray, first: np.ndarray, distance: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The classes (or kinds) of the words so far to the left and to the right; 0 beyond the text's edges."""
    left, right = np.zeros_like(classes), np.zeros_like(classes)
    of = owner(first)
    same = of[distance:] == of[:-distance]
    left[distance:], right[:-distance] = np.where(same, classes[:-distance], 0), np.where(same, classes[distance:], 0)
    return left, right


def summed(docs: DataFrame, size: int, count: Callable[[Chunk], np.ndarray]) -> np.ndarray:
    """The sum over all documents of a count table of a fixed size, one compressed table of the cells that are not zero for each task, united in a tree."""

    def packed(total: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(total)
        table = zlib.compress(at.astype(np.int32).tobytes() + total[at].tobytes(), 1)
        return pa.RecordBatch.from_pydict({"part": pa.array([0], pa.int32()), "table": pa.array([table], pa.binary())})

    def unpacked(table: bytes, total: np.ndarray) -> None:
        raw = zlib.decompress(table)
        n = len(raw) // 12
        total[np.frombuffer(raw, np.int32, n)] += np.frombuffer(raw[4 * n :], np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for c in chunks(batches):
            total += count(c)
        yield packed(total)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column("table"):
                unpacked(x.as_py(), total)
        yield packed(total)

    schema = "part int, table binary"
    united = docs.select("doc_id", "text").mapInArrow(tidied(run), schema)
    parts = united._jdf.queryExecution().toRdd().getNumPartitions()
    while parts > 1:
        parts = -(-parts // _TREE)
        united = united.repartition(parts).mapInArrow(add, schema)
    total = np.zeros(size, np.int64)
    for row in united.collect():  # one table of a fixed size
        unpacked(row["table"], total)
    return total


@dataclass
class Classes:
    of_bucket: np.ndarray  # 0 where the shape decides
    of_shape: np.ndarray
    kind: np.ndarray  # by class

    def of(self, words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        own = self.of_bucket[_bucket(words)]
        return np.where(own > 0, own, self.of_shape[shapes]).astype(np.int64)

    def windows(self, k: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The number of each token's window: the kinds of the words around it."""
        kind, out = self.kind[k].astype(np.int64), np.zeros(len(k), np.int64)
        for d in REACH:
            for side in _sides(kind, first, d):
                out = out * KINDS + side
        return out


@dataclass
class Model:
    classes: Classes
    mass: np.ndarray  # by class: tokens
    kinds: np.ndarray  # by class: distinct words
    log_table: np.ndarray  # by window * CLASSES + class
    rows: DataFrame | None = None  # the documents counted; not sent to tasks


def frequent(counts: np.ndarray) -> np.ndarray:
    """Class by bucket: those of the largest counts have their own, the others none (0)."""
    out = np.zeros(len(counts), np.int16)
    top = np.argsort(-counts, kind="stable")[:_SINGLE]
    out[top] = np.where(counts[top] > 0, np.arange(1, _SINGLE + 1), 0)
    return out


def clusters(x: np.ndarray, n: np.ndarray, k: int, *, rounds: int = 20, seed: int = 5) -> np.ndarray:
    """The number (below k) of each row's cluster, by k-means with weights."""
    rng = np.random.default_rng(seed)
    centre = [x[int(np.argmax(n))]]
    gap = ((x - centre[0]) ** 2).sum(1)
    for _ in range(k - 1):  # far points are likely centres
        p = gap * n
        centre.append(x[rng.choice(len(x), p=p / p.sum())] if p.sum() > 0 else x[rng.integers(len(x))])
        gap = np.minimum(gap, ((x - centre[-1]) ** 2).sum(1))
    centres = np.array(centre)
    for _ in range(rounds):
        best = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
        weight = np.bincount(best, n, k)
        moved = np.stack([np.bincount(best, n * x[:, j], k) for j in range(x.shape[1])], axis=1)
        centres = np.where(weight[:, None] > 0, moved / np.maximum(weight, 1e-9)[:, None], centres)
    return np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)


def classify(own: np.ndarray, near: np.ndarray) -> Classes:
    """Classes and kinds from the counts of frequent neighbours: a row for each shape, then one for each frequent class."""

    def shares(table: np.ndarray) -> np.ndarray:
        prior = near.sum(0) + 1.0
        return np.sqrt((table + prior / prior.sum()) / (table.sum(1, keepdims=True) + 1))

    shapes = near[: 1 << SHAPE_BITS]
    of_shape = clusters(shares(shapes), shapes.sum(1).astype(float), CLASSES - 1 - _SINGLE)
    table = np.zeros((CLASSES, near.shape[1]))
    table[: _SINGLE + 1] = near[1 << SHAPE_BITS :]
    np.add.at(table, _SINGLE + 1 + of_shape, shapes)
    kind = 1 + clusters(shares(table), table.sum(1), KINDS - 1)
    kind[0] = 0
    return Classes(own, (_SINGLE + 1 + of_shape).astype(np.int16), kind.astype(np.int16))


def train(counts: np.ndarray, *, hidden: int = 32, epochs: int = 120, rate: float = 0.05, seed: int = 11) -> np.ndarray:
    """log P(class | window) for all windows, by full-batch Adam on the counts of classes in each window."""
    places = 2 * len(REACH)
    n = counts.reshape(-1, CLASSES).astype(np.float64)
    total = max(n.sum(), 1.0)
    seen = np.flatnonzero(n.sum(1))
    flat = n[seen] / total
    w = flat.sum(1, keepdims=True)
    kinds = np.stack(np.unravel_index(np.arange(len(n)), (KINDS,) * places), axis=1)
    rng = np.random.default_rng(seed)
    p = {"in": rng.normal(0, 0.3, (places, KINDS, hidden)), "bias": np.zeros(hidden), "out": rng.normal(0, 0.1, (hidden, CLASSES)), "prior": np.log((n.sum(0) + 0.5) / (total + 0.5 * CLASSES))}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def forward(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(sum(p["in"][j][x[:, j]] for j in range(places)) + p["bias"])
        z = h @ p["out"] + p["prior"]
        z -= z.max(1, keepdims=True)
        return h, z - np.log(np.exp(z).sum(1, keepdims=True))

    x = kinds[seen]
    for step in range(1, epochs + 1):
        h, logp = forward(x)
        dz = w * np.exp(logp) - flat
        dh = (dz @ p["out"].T) * (1 - h * h)
        into = np.zeros_like(p["in"])
        for j in range(places):
            np.add.at(into[j], x[:, j], dh)
        grad = {"in": into, "bias": dh.sum(0), "out": h.T @ dz, "prior": dz.sum(0)}
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-9)
    return np.concatenate([forward(part)[1].astype(np.float32).ravel() for part in np.array_split(kinds, 8)])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fit(docs: DataFrame, **options: float) -> Model:
    """Four jobs: token counts, shapes' neighbours, classes by window, distinct words; training on the driver. Words and pairs are counted as documents are scored."""
    rows = _rows(docs, "doc_id", "text")
    own = frequent(summed(rows, 1 << BUCKET_BITS, lambda c: np.bincount(_bucket(_tokens(c)[0]), minlength=1 << BUCKET_BITS)))
    width = _SINGLE + 1
    cells = 2 * width * ((1 << SHAPE_BITS) + width)

    def neighbours(c: Chunk) -> np.ndarray:
        words, shapes, first = _tokens(c)
        k = own[_bucket(words)].astype(np.int64)
        left, right = _sides(k, first)
        row = np.where(k > 0, k + (1 << SHAPE_BITS), shapes) * 2 * width
        return np.bincount(np.concatenate((row + left, row + width + right)), minlength=cells)

    near = summed(rows, cells, neighbours).reshape(-1, 2 * width)
    near[:, [0, width]] = 0  # what is not frequent says nothing
    classes = classify(own, near)

    def windows(c: Chunk) -> np.ndarray:
        words, shapes, first = _tokens(c)
        k = classes.of(words, shapes)
        return np.bincount(classes.windows(k, first) * CLASSES + k, minlength=size)

    size = KINDS ** (2 * len(REACH)) * CLASSES
    counts = summed(rows, size, windows)
    return Model(classes, counts.reshape(-1, CLASSES).sum(0), vocabulary(rows, classes), train(counts, **options), rows)


def vocabulary(rows: DataFrame, classes: Classes) -> np.ndarray:
    """The number of distinct words of each class: words of a flush go once to their bucket, which counts them."""
    pieces = groups(rows)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        keys = distinct(np.concatenate(held))
        p, cut = _cut(keys, pieces)
        return pa.RecordBatch.from_pydict({"p": pa.array(p, pa.int64()), "keys": pa.array([keys[a:b].tobytes() for a, b in cut], pa.binary())})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for c in chunks(batches):
            words, shapes, _ = _tokens(c)
            held.append(distinct(_word_keys(words, classes.of(words, shapes))))
            size += len(c.buf)
            if size >= FLUSH_BYTES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    def count(table: pa.Table) -> pa.Table:
        keys = distinct(np.concatenate([np.frombuffer(x.as_py(), U64) for x in table.column("keys")]))
        kinds = np.bincount((keys & U64(255)).astype(np.int64), minlength=CLASSES)
        some = np.flatnonzero(kinds)
        return pa.table({"class": some.astype(np.int32), "n": kinds[some]})

    each = rows.mapInArrow(run, "p long, keys binary").groupBy("p").applyInArrow(count, "class int, n long")
    out = np.zeros(CLASSES)
    for r in each.groupBy("class").agg(F.sum("n").alias("n")).collect():  # a row for each class
        out[r["class"]] = r["n"]
    return out


def _planes(x: np.ndarray) -> bytes:
    """Byte after byte of all numbers, so that high bytes, mostly zero, compress."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _cut(keys: np.ndarray, pieces: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The buckets that sorted keys belong to, and each bucket's part of the keys."""
    p = ((keys >> U64(32)) * U64(pieces) >> U64(32)).astype(np.int64)
    if not len(p):
        return p, []
    at = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
    return p[at], list(zip(at.tolist(), np.append(at[1:], len(p)).tolist(), strict=True))


def _word_keys(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    return (mix(words) & ~U64(255)) | k.astype(U64)


def _keys(words: np.ndarray, first: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The key of each word, the key of its pair with the next word, and whether there is one in its document."""
    word = _word_keys(words, k)
    nxt = np.append(words[1:], U64(0))[: len(words)]
    pair = mix(words * U64(0xA24BAED4963EE407) + mix(nxt)) & ~U64(255)  # class 0: no word has it
    has = np.ones(len(words), bool)
    some = first[:-1] < first[1:]
    has[first[1:][some] - 1] = False
    return word, pair, has


def _read(table: pa.Table, classes: Classes) -> tuple[pa.Array | list, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, word hashes, their classes and each document's first word, of a whole group."""
    ids, words, kinds, first, n = [], [np.empty(0, U64)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)], 0
    for c in chunks(table.to_batches()):
        w, s, f = _tokens(c)
        ids.append(c.ids)
        words.append(w)
        kinds.append(classes.of(w, s))
        first.append(f[1:] + n)
        n += len(w)
    return ids, np.concatenate(words), np.concatenate(kinds), np.concatenate(first)


def _messages(rows: DataFrame, pieces: int, sent: object, *, asks: bool, tells: bool) -> DataFrame:
    """One message of each group to each bucket that it has keys of: distinct keys and their counts (0 unless it tells); g is -1 unless it asks."""

    def run(table: pa.Table) -> pa.Table:
        _, words, k, first = _read(table, sent.value.classes)
        word, pair, has = _keys(words, first, k)
        keys, counts = np.unique(np.concatenate((word, pair[has])), return_counts=True)
        p, cut = _cut(keys, pieces)
        step = [np.diff(keys[a:b], prepend=U64(0)) for a, b in cut]
        g = table.column("g")[0].as_py()
        return pa.table({"g": pa.array([g if asks else -1] * len(p), pa.int64()), "p": pa.array(p, pa.int64()), "keys": pa.array(map(_planes, step), pa.binary()), "counts": pa.array([_planes(counts[a:b] * tells) for a, b in cut], pa.binary())})

    return rows.groupBy("g").applyInArrow(run, _MESSAGE)


def _answers(messages: DataFrame) -> DataFrame:
    """To each message that asks: the counts over all messages, in the order of its keys."""

    def run(table: pa.Table) -> pa.Table:
        g = table.column("g").to_pylist()
        keys = [np.cumsum(_numbers(x.as_py()), dtype=U64) for x in table.column("keys")]
        found = distinct(np.concatenate(keys))
        total = np.zeros(len(found), U64)
        for x, counts in zip(keys, table.column("counts"), strict=True):
            total[np.searchsorted(found, x)] += _numbers(counts.as_py())  # a message's keys are distinct
        asked = [k for k, x in enumerate(g) if x >= 0]
        p = table.column("p")[0].as_py()
        return pa.table({"g": pa.array([g[k] for k in asked], pa.int64()), "p": pa.array([p] * len(asked), pa.int64()), "counts": pa.array([_planes(total[np.searchsorted(found, keys[k])]) for k in asked], pa.binary())})

    return messages.groupBy("p").applyInArrow(run, "g long, p long, counts binary")


def _likelihoods(words: np.ndarray, k: np.ndarray, first: np.ndarray, answers: pa.Table, m: Model, own: int) -> np.ndarray:
    """log P(token | neighbours) of each token; own is 1 if the tokens' places are in the counts."""
    word, pair, has = _keys(words, first, k)
    at = numbered(np.concatenate((word, pair[has])))
    rows = answers.sort_by("p")
    total = np.concatenate([_numbers(x.as_py()) for x in rows.column("counts")]).astype(np.float64)
    others = np.maximum(total - own, 0.0)
    n, pairs = others[at[: len(word)]], np.zeros(len(words))
    pairs[has] = others[at[len(word) :]]
    # by the left and by the right word; an edge says nothing
    after, before = np.append(0.0, pairs[:-1]), pairs
    left, right = np.append(0.0, np.where(has, n, 0.0)[:-1]), np.where(has, np.append(n[1:], 0.0), 0.0)
    share = (n + 0.5) / (np.maximum(m.mass[k] - own, 0.0) + 0.5 * (m.kinds[k] + 1))  # one more for words never seen
    prior = np.exp(m.log_table[m.classes.windows(k, first) * CLASSES + k].astype(np.float64)) * share
    places = left + right
    weight = PRIOR + SPREAD * places**GROWTH
    return np.log((after + before + weight * prior) / (places + weight))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, log_likelihood, mean_log_likelihood) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(replace(model, rows=None))  # a fixed size, about 8 MB
    kind = docs.schema[id_col].dataType.simpleString()
    rows = _rows(docs, id_col, text_col)
    same = rows.sameSemantics(model.rows)

    def dealt(x: DataFrame) -> DataFrame:
        return x.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups(x, GROUP_BYTES // 2))))

    given, pieces = dealt(rows), groups(model.rows)
    messages = _messages(given, pieces, sent, asks=True, tells=same)
    if not same:
        messages = messages.unionByName(_messages(dealt(model.rows), pieces, sent, asks=False, tells=True))

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, words, k, first = _read(table, sent.value.classes)
        total = np.zeros(len(first) - 1)
        if len(words):
            total = np.bincount(owner(first), _likelihoods(words, k, first, answers, sent.value, int(same)), len(total))
        n = np.diff(first).astype(np.int64)
        return pa.table({"id": pa.chunked_array(ids, table.schema.field("doc_id").type), "n_tokens": n, "log_likelihood": np.round(total, 4), "mean_log_likelihood": pa.array(np.round(total / np.maximum(n, 1), 6), mask=n == 0)})

    scored = given.groupBy("g").cogroup(_answers(messages).groupBy("g")).applyInArrow(run, f"id {kind}, n_tokens long, log_likelihood double, mean_log_likelihood double")
    return scored.withColumnRenamed("id", id_col)


__all__ = ["CLASSES", "Classes", "KINDS", "Model", "REACH", "fit", "score", "summed", "train", "vocabulary"]
