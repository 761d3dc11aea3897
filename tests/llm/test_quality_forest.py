"""The quality verdict comes from the forest's path lengths: held against a plain walk of its trees, on planted and on real rows."""

import math
import random
import re

import numpy as np

from postatlas.llm import quality
from tests.conftest import SF

from . import plain


def rates(text):
    """The statistics of one text as the forest reads them."""
    t = text or ""
    words, lines = re.findall(plain.SPACED, t), [x for x in t.split("\n") if re.search(plain.SPACED, x)]
    (_, n, chars, symbols, dup, repeat, _) = plain.counts([(0, t)])[0]
    n, size = max(n, 1), max(chars, 1)
    raw = [symbols / size, dup / max(len(lines), 1), repeat / n, sum("A" <= c <= "Z" for c in t) / size, sum(c in "!?" for c in t) / n, sum("0" <= c <= "9" for c in t) / size]
    return [math.log1p(1000 * x) for x in raw] + [chars / n, len(set(words)) / math.sqrt(n)]


def walk(forest, x):
    """The score of one row: every tree walked node by node."""
    inner, total = forest.feature.shape[1], 0.0
    for f, v, p in zip(forest.feature.tolist(), forest.value.tolist(), forest.path.tolist(), strict=True):
        node = 0
        while node < inner:
            node = 2 * node + 1 + (x[f[node]] >= v[node])
        total += p[node - inner]
    return 2 ** -(total / len(forest.path) / forest.norm)


def test_kept_is_the_walk_of_the_trees(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    forest = quality.fit(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in quality.judge(docs, forest).collect()}
    failed = {c[0]: c[6] for c in plain.counts(text.items())}
    for i, t in text.items():
        score = walk(forest, rates(t))
        assert abs(got[i].score - score) < 1e-6
        if abs(score - forest.threshold) > 1e-6:
            assert got[i].kept == (not failed[i] and score <= forest.threshold)
    assert {r.doc_id for r in quality.keep_good(docs, forest).collect()} == {i for i, r in got.items() if r.kept}


def test_forest_finds_what_no_single_limit_tells():
    rnd = np.random.default_rng(3)
    k = len(quality.FEATURES)
    good = rnd.normal(0, 0.05, (2000, k))
    good[:, 0] = rnd.choice([0.0, 1.0], 2000)
    good[:, 1] = 1 - good[:, 0] + rnd.normal(0, 0.05, 2000)  # high or low together never in accepted rows
    bad = rnd.normal(0, 0.05, (200, k))
    bad[:, 0] = rnd.choice([0.0, 1.0], 200)
    bad[:, 1] = bad[:, 0] + rnd.normal(0, 0.05, 200)
    bad[:, 2] += 0.3
    x, y = np.concatenate((good, bad)), np.arange(2200) >= 2000
    half = rnd.random(2200) < 0.5
    forest = quality.train(x[half], y[half])
    out = forest.score(x[~half]) > forest.threshold
    assert out[y[~half]].mean() > 0.9 and out[~y[~half]].mean() < 0.02


def test_labels_of_one_id_and_edges(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("abcdefghij") * rnd.randint(3, 8) for _ in range(80)) + (" #$%&|" * 40 if i % 5 == 0 else "")) for i in range(100)]
    rows += [(3, rows[3][1]), (None, "x " * 90), (200, None), (201, "")]
    docs = spark.createDataFrame([(i, t, 1.5, "y") for i, t in rows], "doc_id long, text string, score double, kept string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(100)] + [(7, 1), (10, 1), (None, 0), (8, None)], "doc_id long, quality int")
    a, b = quality.fit(docs, labels), quality.fit(docs.repartition(5), labels.repartition(4))
    assert a.threshold == b.threshold and np.array_equal(a.path, b.path)
    got = {r.doc_id: r for r in quality.judge(docs, a).collect()}
    assert not got[10].kept and got[11].kept and not got[200].kept and not got[201].kept
    assert quality.keep_good(docs, a).schema == docs.schema
    assert quality.fit(docs.limit(0), labels) is None
    only = quality.fit(docs, labels.where("quality = 1"))
    assert sum(r.kept for r in quality.judge(docs, only).collect()) >= 75
