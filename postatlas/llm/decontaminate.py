"""Benchmark decontamination with suffix arrays over training shards.

A shard is a chunk of documents.  Its suffix array holds the word suffixes that
can start a match (their first words start some test suffix), sorted by their
first words' fingerprints.  Every test suffix is binary-searched in every shard
by narrowing its interval word after word; occurrences of a window on one
diagonal are joined to the longest verbatim matches with their locations.

Words are lower-cased (A-Z) runs of letters, digits and characters beyond
ASCII.  A window is ``window`` consecutive words of an item; an item of fewer
words, but not none, is one window.

Scale: documents are only scanned; texts are never shuffled.  Test items are
sent to the tasks in passes of at most ``pass_bytes`` of text each, however
large the benchmark is, one pass after another: the driver holds the items of
one pass.  With several passes, only the keys of documents and the rows that
were hit are grouped.

Edge cases: null texts have no words; items without words match nothing; an
item without an item_id hits words, but is not an item of any list; a repeated
item_id counts once; repeated documents are judged each; an empty benchmark
hits nothing; an empty table gives an empty one; ids may be null (documents are
told apart by their texts); columns beyond id and text pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scale import checkpoint_dir
from .textcore import ALNUM_WORDS, CHUNK_BYTES, LOWER, U64, Chunk, Spans, chunks, covered, mix, owner, runs, split_words, tidied, utf8, word_hashes

#: Benchmark text sent to the tasks at once.
PASS_BYTES = 16 << 20
_FILTER_BITS = 22
#: What a document gets in one pass.
FOUND = "n_words long, spans array<struct<start:int,end:int>>, items array<string>, matches array<struct<item:string,word:int,words:int>>"


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    buf = LOWER[buf]
    starts, ends, first = split_words(buf, offs, ALNUM_WORDS)
    return word_hashes(buf, starts, ends), first


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix(a + b * U64(0x9FB21C651E98DF25)) >> U64(64 - _FILTER_BITS)).astype(np.int64)


def _bisect(column: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each key in its own sorted interval [a, b) of the column."""
    while (open_ := a < b).any():
        m = (a + b) >> 1
        v = column[np.minimum(m, len(column) - 1)]
        up = open_ & ((v <= key) if right else (v < key))
        a, b = np.where(up, m + 1, a), np.where(open_ & ~up, m, b)
    return a


@dataclass
class Tests:
    """Test suffixes: their words lie flat in ``words`` from ``start``; a search has ``depth`` words."""

    words: np.ndarray
    start: np.ndarray
    depth: np.ndarray
    item: np.ndarray
    names: list[str | None]
    firsts: np.ndarray
    pairs: np.ndarray

    @classmethod
    def build(cls, ids: list[str | None], texts: list[str | None], window: int) -> Tests:
        words, first = _words(*utf8(pa.array(texts, pa.string())))
        size = np.diff(first)
        n = np.where(size >= window, size - window + 1, np.minimum(size, 1))
        item = np.repeat(np.arange(len(size)), n)
        start = first[:-1][item] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        depth = np.minimum(size, window)[item]
        firsts, pairs = np.zeros(1 << _FILTER_BITS, bool), np.zeros(1 << _FILTER_BITS, bool)
        one = depth == 1
        firsts[_pair(words[start[one]], words[start[one]])] = True
        pairs[_pair(words[start[~one]], words[start[~one] + 1])] = True
        return cls(words, start, depth, item, ids, firsts, pairs)

    def search(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(test suffix, position in the shard) of all occurrences of searched windows."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(self.start) or not len(words):
            return none
        nxt = np.append(words[1:], U64(0))
        suffix = np.flatnonzero(self.pairs[_pair(words, nxt)] | self.firsts[_pair(words, words)])
        if not len(suffix):
            return none
        deepest = int(self.depth.max())
        room = first[1:][owner(first)] - np.arange(len(words))  # words up to the document's end
        padded = np.concatenate((words, np.zeros(deepest, U64)))
        column = [np.where(room[suffix] > d, padded[suffix + d], U64(0)) for d in range(deepest)]
        order = np.lexsort(column[::-1])
        suffix, column = suffix[order], [c[order] for c in column]
        lo, hi = np.zeros(len(self.start), np.int64), np.full(len(self.start), len(suffix))
        for d in range(deepest):
            go = np.flatnonzero((self.depth > d) & (lo < hi))
            word = self.words[self.start[go] + d]
            lo[go] = _bisect(column[d], lo[go], hi[go], word, False)
            hi[go] = _bisect(column[d], lo[go], hi[go], word, True)
        count = np.maximum(hi - lo, 0)
        test = np.repeat(np.arange(len(count)), count)
        at = lo[test] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        where = suffix[at]
        inside = room[where] >= self.depth[test]
        return test[inside], where[inside]


def shard(c: Chunk, tests: Tests, tagged: bool = False) -> pa.RecordBatch:
    """The matches of one shard, a row for each document; tag is the text's fingerprint, or 0."""
    words, first = _words(c.buf, c.offs)
    test, where = tests.search(words, first)
    n = len(c)
    spans, items, matches = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
    if len(test):
        of = owner(first)
        flag = covered(where, tests.depth[test], len(words))
        s, e = runs(flag)
        # runs must not join across documents
        cuts = first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(words))]
        bounds = np.unique(np.concatenate((s, e, cuts[flag[cuts] & flag[cuts - 1]])))
        s, e = bounds[:-1], bounds[1:]
        s, e = s[flag[s]], e[flag[s]]
        for a, b in zip(s.tolist(), e.tolist(), strict=True):
            d = of[a]
            spans[d].append({"start": a - int(first[d]), "end": b - int(first[d])})
        # longest verbatim matches: neighbours on one diagonal of one item and document
        item, doc = tests.item[test], of[where]
        diagonal = where - tests.start[test]
        order = np.lexsort((where, diagonal, item, doc))
        k = [x[order] for x in (doc, item, diagonal, where, tests.depth[test])]
        new = np.ones(len(order), bool)
        new[1:] = (k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]) | (k[2][1:] != k[2][:-1]) | (k[3][1:] != k[3][:-1] + 1)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(order)) - 1
        size = k[3][last] + k[4][last] - k[3][begin]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for d, i, w, m in zip(k[0][begin].tolist(), k[1][begin].tolist(), k[3][begin].tolist(), size.tolist(), strict=True):
            if m > best.get((d, i), (0, 0))[0]:
                best[d, i] = (m, w - int(first[d]))
        for (d, i), (m, w) in sorted(best.items()):
            if tests.names[i] is None:
                continue
            items[d].append(tests.names[i])
            matches[d].append({"item": tests.names[i], "word": w, "words": m})
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    match_type = pa.list_(pa.struct([("item", pa.string()), ("word", pa.int32()), ("words", pa.int32())]))
    return pa.RecordBatch.from_pydict({"id": c.ids, "tag": pa.array(Spans(c.buf).hash(c.offs[:-1], c.offs[1:]).view(np.int64) if tagged else np.zeros(n, np.int64)), "n_words": np.diff(first).astype(np.int64), "spans": pa.array(spans, span_type), "items": pa.array(items, pa.list_(pa.string())), "matches": pa.array(matches, match_type)})


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unite overlapping spans of several passes."""
    for b in batches:
        out = []
        for row in b.column("spans").to_pylist():
            united: list[dict] = []
            for s in sorted((x for part in row or [] for x in part), key=lambda x: (x["start"], x["end"])):
                if united and s["start"] <= united[-1]["end"]:
                    united[-1]["end"] = max(united[-1]["end"], s["end"])
                else:
                    united.append(dict(s))
            out.append(united)
        yield b.set_column(b.schema.get_field_index("spans"), "spans", pa.array(out, b.column("spans").type.value_type))


def _passes(benchmark: DataFrame, window: int, pass_bytes: int, item_id: str, item_text: str) -> tuple[int, Callable[[int], Broadcast]]:
    """The number of passes, and what sends the test suffixes of one; all rows of an item are in one pass."""
    tests = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text")).where("text is not null").distinct()
    total = tests.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    passes = max(1, -(-int(total) // pass_bytes))

    def sent(k: int) -> Broadcast:
        part = tests if passes == 1 else tests.where(F.pmod(F.coalesce(F.xxhash64("item"), F.xxhash64("text")), F.lit(passes)) == k)
        got = part.orderBy("item", "text").collect()  # about pass_bytes
        return benchmark.sparkSession.sparkContext.broadcast(Tests.build([r[0] for r in got], [r[1] for r in got], window))

    return passes, sent


def find_matches(docs: DataFrame, benchmark: DataFrame, *, window: int = 8, pass_bytes: int = PASS_BYTES, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """For every document: (id, n_words, spans, items, matches); matches are the longest of each item with their places in words."""
    passes, sent = _passes(benchmark, window, pass_bytes, item_id, item_text)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def found(built: Broadcast) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for c in chunks(batches, 2 * CHUNK_BYTES):
                yield shard(c, built.value, passes > 1)

        return rows.mapInArrow(tidied(run), f"id {kind}, tag long, {FOUND}")

    if passes == 1:
        return found(sent(0)).drop("tag").withColumnRenamed("id", id_col)
    checkpoint_dir(docs.sparkSession)
    key, hits = ["id", "tag", "n_words"], None
    for k in range(passes):
        built = sent(k)
        # rows of one id and one text have the same matches
        part = found(built).where("size(spans) > 0").dropDuplicates(key).checkpoint()
        built.destroy()
        hits = part if hits is None else hits.unionByName(part)
    united = hits.groupBy(*key).agg(F.collect_list("spans").alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("matches")).alias("matches"))
    united = united.mapInArrow(_merged, f"id {kind}, tag long, {FOUND}").select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), "spans", "items", "matches")
    nothing = docs.sparkSession.sparkContext.broadcast(Tests.build([], [], window))
    out = found(nothing).select(*key).join(united, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
    empty = {f.name: F.coalesce(f.name, F.array().cast(f.dataType)) for f in united.schema if f.name in ("spans", "items", "matches")}
    return out.select("id", "n_words", *(x.alias(c) for c, x in empty.items())).withColumnRenamed("id", id_col)


def judged(found: DataFrame, *, min_items: int = 2) -> DataFrame:
    """Adds n_hit, n_items, items_sha256, contaminated and longest (words of the longest match)."""
    names = F.array_sort(F.array_distinct("items"))
    return found.select(
        "*",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size(names) >= min_items).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])), F.lit(0)).alias("longest"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = 8, min_items: int = 1, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The documents hit by fewer than ``min_items`` items, with their own columns, each judged in the scan that reads it.

    One scan for each pass over the benchmark; hits are counted in an added
    column until the last.  An item without an id has no part in the count.
    """
    passes, sent = _passes(benchmark, window, pass_bytes, "item_id", "text")
    count = "_items"
    while count in docs.columns:
        count = f"_{count}"
    out = docs.withColumn(count, F.lit(0))
    if passes > 1:
        checkpoint_dir(docs.sparkSession)
    for k in range(passes):
        built = sent(k)

        def run(batches: Iterable[pa.RecordBatch], built: Broadcast = built) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                plain = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text").cast(pa.string())], names=["doc_id", "text"])
                hits = [shard(c, built.value).column("items") for c in chunks([plain], 2 * CHUNK_BYTES)]
                n = np.concatenate([np.zeros(0, np.int32), *(h.value_lengths().to_numpy(zero_copy_only=False) for h in hits)]).astype(np.int32)
                n += batch.column(count).to_numpy(zero_copy_only=False)
                at = batch.schema.get_field_index(count)
                yield batch.set_column(at, count, pa.array(n)).filter(pa.array(n < min_items))

        out = out.mapInArrow(tidied(run), out.schema)
        if passes > 1:
            out = out.checkpoint()
            built.destroy()
    return out.drop(count)
