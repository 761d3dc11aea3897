"""Quality rules: base rules on exact counts, then an isolation forest on rule statistics.

The forest isolates points by random splits of random statistics; documents
with short mean path lengths are anomalous.  Its trees hold accepted documents
and draw split values from the box of all labelled ones, so a region that no
accepted document fills is cut off near the root.  The labels set how often a
statistic is split (by how well it alone ranks rejected above or below accepted
documents) and calibrate the threshold; no statistic has a limit of its own.

Fitting reads at most ``sample`` labelled documents (those with the smallest
hash of their id, a documented bound); scoring reads every document.

Edge cases: a null or empty text has no words, fails the base rules and is
rejected; a null id passes through; without any accepted label no forest is
fitted and the base rules decide alone; without rejected labels all statistics
are split alike and the threshold is the ``keep`` quantile of accepted scores;
an id with several labels has the smallest; of repeated rows of one id with
different texts the fit takes the one with the smallest hash; repeated rows
are judged each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcore import SPACE_WORDS, U64, Chunk, Spans, chunks, covered, mix, owner, per_document, split_words, tidied, windows, word_hashes

#: Labelled documents read for fitting and calibration.
SAMPLE = 6000
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!?")] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[0x30:0x3A] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rates are read on a logarithmic scale, from a thousandth up.
RATES = ("symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "mark_rate", "digit_rate")
FEATURES = (*RATES, "word_length", "new_word_rate")
#: A statistic that does not tell the labels apart is split this often, against 1 for one that tells all apart.
LEAST_WEIGHT = 0.02


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    at = np.searchsorted(twice, keys)
    return (at < len(twice)) & (twice[np.minimum(at, len(twice) - 1)] == keys) if len(twice) else np.zeros(len(keys), bool)


def _distinct(keys: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct keys of each document; keys of different documents differ."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.bincount(of[order[new]], minlength=n)


def statistics(c: Chunk) -> dict[str, np.ndarray]:
    """The counts and the features of each document of a chunk."""
    buf, offs, n = c.buf, c.offs, len(c)
    starts, ends, first = split_words(buf, offs, SPACE_WORDS)
    hashes, of = word_hashes(buf, starts, ends), owner(first)
    salt = mix(np.arange(1, n + 1, dtype=U64))
    n_words = np.diff(first).astype(np.int64)

    points = (buf & 0xC0) != 0x80
    chars = per_document(points & SPACE_WORDS[buf], offs)
    out = {"n_words": n_words, "word_chars": chars}
    out["n_symbols"] = per_document(_SYMBOLS[buf], offs)

    # lines: cut at line feeds and at documents' ends
    feeds = np.flatnonzero(buf == 10)
    line_of = np.searchsorted(offs, feeds, "right") - 1
    ls = np.concatenate((offs[:-1], feeds + 1))
    le = np.concatenate((feeds, offs[1:]))
    ld = np.concatenate((np.arange(n), line_of))
    order = np.lexsort((ls, ld))
    ls, ld = ls[order], ld[order]
    order = np.lexsort((le, np.concatenate((line_of, np.arange(n)))))
    le = le[order]
    word = np.searchsorted(starts, ls) < np.searchsorted(starts, le)
    ls, le, ld = ls[word], le[word], ld[word]
    lh = word_hashes(buf, ls, le)
    n_lines = np.bincount(ld, minlength=n)
    out["n_dup_lines"] = n_lines - _distinct(mix(lh ^ salt[ld]), ld, n)

    wh, ws = windows(hashes, first, 3)
    again = _repeats(mix(wh ^ salt[of[ws]]))
    inside = covered(ws[again], 3, len(hashes)) if len(hashes) else np.zeros(0, bool)
    out["n_repeat_words"] = per_document(inside, first)

    words, size = np.maximum(n_words, 1), np.maximum(chars, 1)
    out["symbol_rate"] = out["n_symbols"] / size
    out["dup_line_rate"] = out["n_dup_lines"] / np.maximum(n_lines, 1)
    out["repeat_rate"] = out["n_repeat_words"] / words
    out["upper_rate"] = per_document(_UPPER[buf], offs) / size
    out["mark_rate"] = per_document(_MARKS[buf], offs) / words
    out["word_length"] = chars / words
    # distinct words among all, per the square root of the length: even for short and long texts
    out["new_word_rate"] = _distinct(mix(hashes ^ salt[of]), of, n) / np.sqrt(words) if len(hashes) else np.zeros(n)
    out["digit_rate"] = per_document(_DIGITS[buf], offs) / size
    return out


def base_failed(s: dict[str, np.ndarray], min_words: int = 50, max_repeat: int = 50) -> np.ndarray:
    return (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeat * s["n_words"])


@dataclass
class Forest:
    """Complete binary trees of one depth: split feature and value of inner nodes, path length at leaves."""

    feature: np.ndarray  # trees x inner nodes
    value: np.ndarray
    path: np.ndarray  # trees x leaves
    norm: float
    threshold: float = np.inf

    @staticmethod
    def _mean_path(n: np.ndarray) -> np.ndarray:
        """Mean depth of an unsuccessful search among n points."""
        n = np.maximum(np.asarray(n, float), 1)
        return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))

    @classmethod
    def fit(cls, x: np.ndarray, low: np.ndarray, high: np.ndarray, weight: np.ndarray, *, trees: int = 100, points: int = 256, seed: int = 7) -> Forest:
        """Trees over rows of ``x``; split values lie in the box from ``low`` to ``high``, statistics are drawn by ``weight``."""
        rng = np.random.default_rng(seed)
        points = min(points, len(x))
        depth = max(1, int(np.ceil(np.log2(max(points, 2)))))
        inner = (1 << depth) - 1
        feature, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
        path = np.zeros((trees, inner + 1))
        can = np.flatnonzero(high > low)
        share = weight[can] / weight[can].sum() if len(can) else weight[can]
        for t in range(trees):
            held = {0: (x[rng.choice(len(x), points, replace=False)], low, high)}
            ended: dict[int, float] = {}
            for node in range(inner):
                rows, lo, hi = held.pop(node, (x[:0], low, high))
                level = (node + 1).bit_length() - 1
                if node in ended or len(rows) < 2 or not len(can):
                    end = ended.get(node, level + float(cls._mean_path(len(rows))))
                    ended[2 * node + 1] = ended[2 * node + 2] = end
                    continue
                f = rng.choice(can, p=share)
                cut = rng.uniform(lo[f], hi[f])
                feature[t, node], value[t, node] = f, cut
                right = rows[:, f] >= cut
                below, above = hi.copy(), lo.copy()
                below[f] = above[f] = cut
                held[2 * node + 1], held[2 * node + 2] = (rows[~right], lo, below), (rows[right], above, hi)
            for leaf in range(inner + 1):
                node = inner + leaf
                path[t, leaf] = ended.get(node, depth + float(cls._mean_path(len(held[node][0]) if node in held else 0)))
        return cls(feature, value, path, float(cls._mean_path(points)) or 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; anomalous documents near 1."""
        total = np.zeros(len(x))
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for f, v, p in zip(self.feature, self.value, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:  # all trees are complete: every row is on one level
                node = 2 * node + 1 + (x[rows, f[node]] >= v[node])
            total += p[node - inner]
        return 2.0 ** -(total / len(self.path) / self.norm)

    def calibrate(self, scores: np.ndarray, bad: np.ndarray, keep: float) -> None:
        """The lowest threshold, above the ``keep`` quantile of accepted scores, that best splits the labels."""
        good = np.sort(scores[~bad])
        least = good[min(len(good) - 1, int(np.ceil(keep * len(good))))] if len(good) else np.inf
        if not bad.any() or not len(good):
            self.threshold = float(least)
            return
        cuts = np.unique(np.append(scores[scores >= least], least))
        caught = len(scores[bad]) - np.searchsorted(np.sort(scores[bad]), cuts, "right")
        lost = len(good) - np.searchsorted(good, cuts, "right")
        gain = caught / bad.sum() - 10 * lost / len(good)
        best = int(np.argmax(gain))
        above = scores[scores > cuts[best]]
        self.threshold = float((cuts[best] + above.min()) / 2) if len(above) else float(cuts[best])


def _scaled(raw: np.ndarray) -> np.ndarray:
    """Raw statistics (a column for each feature) as the forest reads them."""
    out = np.array(raw, float)
    k = len(RATES)
    out[:, :k] = np.log1p(1000 * out[:, :k])
    return out


def _matrix(s: dict[str, np.ndarray]) -> np.ndarray:
    return _scaled(np.column_stack([np.asarray(s[f], float) for f in FEATURES]))


def split_weights(x: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """For each statistic how well it alone ranks the rejected rows apart: 0 as by chance, 1 without an error, in either direction."""
    if not bad.any() or bad.all():
        return np.ones(x.shape[1])
    good, out = np.sort(x[~bad], axis=0), np.empty(x.shape[1])
    for k in range(x.shape[1]):
        below, upto = (np.searchsorted(good[:, k], x[bad, k], side) for side in ("left", "right"))
        out[k] = abs((below + upto).mean() / len(good) - 1)
    return LEAST_WEIGHT + out


def train(x: np.ndarray, bad: np.ndarray, *, keep: float = 0.998, trees: int = 100, points: int = 256) -> Forest | None:
    """A calibrated forest from labelled rows of statistics; None with fewer than two accepted ones."""
    if len(x) - bad.sum() < 2:
        return None
    forest = Forest.fit(x[~bad], x.min(0), x.max(0), split_weights(x, bad), trees=trees, points=points)
    forest.calibrate(forest.score(x), bad, keep)
    return forest


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, keep: float = 0.998, trees: int = 100, points: int = 256) -> Forest | None:
    """A calibrated forest from at most ``sample`` labelled documents."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality")).where("_id is not null and _quality is not null")
    chosen = marked.groupBy("_id").agg(F.min("_quality").alias("_quality")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for c in chunks([batch]):
                s = statistics(c)
                out = {f: pa.array(np.asarray(s[f], float)) for f in FEATURES}
                tag = Spans(c.buf).hash(c.offs[:-1], c.offs[1:]).view(np.int64)
                yield pa.RecordBatch.from_pydict({"doc_id": c.ids, "tag": tag, "quality": batch.column("_quality").slice(at, len(c)).cast(pa.int32()), "failed": base_failed(s), **out})
                at += len(c)

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(tidied(run), f"doc_id {kind}, tag long, quality int, failed boolean, " + ", ".join(f"{f} double" for f in FEATURES))
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("quality", "failed", *FEATURES), "tag").alias("row")).select("doc_id", "row.*")
    got = one.toPandas().sort_values("doc_id")  # at most ``sample`` rows of numbers
    got = got[~got["failed"].astype(bool)]
    return train(_scaled(got[list(FEATURES)].to_numpy(float)), got["quality"].to_numpy() == 0, keep=keep, trees=trees, points=points)


def judge(docs: DataFrame, forest: Forest | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the five counts, base_failed, kept, score) of every row.  Scan only, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            s = statistics(c)
            failed = base_failed(s)
            score = forest.score(_matrix(s)) if forest else np.zeros(len(c))
            kept = ~failed & (score <= forest.threshold if forest else True)
            yield pa.RecordBatch.from_pydict({"id": c.ids, **{k: s[k].astype(np.int64) for k in COUNTS}, "base_failed": failed, "kept": kept, "score": score})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(run), f"id {kind}, " + ", ".join(f"{k} long" for k in COUNTS) + ", base_failed boolean, kept boolean, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The documents that pass, with all their own columns, in one scan."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = [np.empty(0, bool)]
            for c in chunks([batch.select(["doc_id", "text"])]):
                s = statistics(c)
                good = ~base_failed(s)
                if forest:
                    good &= forest.score(_matrix(s)) <= forest.threshold
                flags.append(good)
            yield batch.filter(pa.array(np.concatenate(flags)))

    return docs.mapInArrow(tidied(run), docs.schema)
