"""Models that keep all of what they count: held against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from postatlas.llm import lm_score, url_filter
from postatlas.llm.textcore import chunks
from tests.conftest import SF


def by_hand(known, order):
    """The difference of a text under models of all grams of the known (text, verdict)."""
    count = {v: Counter() for v in ("allow", "block")}
    for t, v in known:
        for at in range(1, len(t) + 1):
            for k in range(1, min(order, at) + 1):
                count[v][t[at - k : at]] += 1
    under = {v: defaultdict(list) for v in count}
    for v, c in count.items():
        for g, n in c.items():
            under[v][g[:-1]].append(n)

    def p(g, v):
        low = p(g[1:], v) if len(g) > 1 else 1 / 256
        if not (count["allow"][g] or count["block"][g]) or not under[v][g[:-1]]:
            return low
        n, t = sum(under[v][g[:-1]]), len(under[v][g[:-1]])
        return (count[v][g] + (t + 1) * low) / (n + t + 1)

    def difference(t):
        return sum(math.log(p(t[max(0, at - order) : at], "allow") / p(t[max(0, at - order) : at], "block")) for at in range(1, len(t) + 1)) / max(1, len(t))

    return difference


@pytest.mark.parametrize("path", [f"{SF}/pages.parquet", "rare"])
def test_url_model_keeps_all_grams(spark, path):
    rare = [f"http://h{i}.com/only{i * 7919}/x" for i in range(20)] + [f"http://k{i}.net/fr/gone{i * 104729}" for i in range(20)] + ["http://o.org/only7919/x", "http://o.org/gone104729", "http://o.org/only7919/x", "http://k3.net/fr/gone314187", None, "x"]
    pages = spark.createDataFrame(list(enumerate(rare)), "page_id long, url string") if path == "rare" else spark.read.parquet(path)
    got = url_filter.judge(pages).collect()
    assert len(got) == pages.count()
    of = by_hand([(r.host + r.path, r.verdict) for r in got if r.rule], url_filter.ORDER)
    for r in got:
        assert r.difference == pytest.approx(of(r.host + r.path), abs=1e-8), r


def test_url_threshold_reads_the_other_fold(spark):
    texts = [(f"t{i % 7}x{i}", "allow" if i % 3 else "block", 1 + i % 2, i % 2, i) for i in range(60)]
    df = spark.createDataFrame(texts, "chars string, verdict string, n long, fold int, row int")
    got = {r.row: r for r in url_filter.differences(df, url_filter.fit(url_filter.counted(df))).collect()}
    for fold in (0, 1):
        of = by_hand([(t, v) for t, v, n, f, _ in texts if f != fold for _ in range(n)], url_filter.ORDER)
        assert all(got[i].held == pytest.approx(of(t), abs=1e-8) for t, _, _, f, i in texts if f == fold)


def test_lm_scores_condition_the_token(spark):
    rnd = random.Random(2)
    names = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rnd.choice(names) for _ in range(rnd.randint(1, 90)))) for i in range(120)] + [(200, None), (None, "w1 w2"), (201, "one"), (202, "w5 w6 w5 w6 w5")]
    rows += [(300, rows[3][1]), (301, rows[40][1] + " tail")]
    w = rows[3][1].split()
    held = [(1, " ".join(w)), (2, " ".join(sorted(w))), (3, "never seen")]  # 2: the same words in another order
    docs, other = (spark.createDataFrame(x, "doc_id long, text string") for x in (rows, held))
    model = lm_score.fit(docs, epochs=5)
    table = model.log_table.reshape(*[lm_score.KINDS] * 4, lm_score.CLASSES)
    of = {}
    for df in (docs, other):
        for c in chunks(df.toArrow().to_batches()):
            hashes, shapes, _ = lm_score._tokens(c)
            of |= dict(zip([x for t in c.texts() for x in t.split()], model.classes.of(hashes, shapes).tolist()))
    one, two, vocabulary = Counter(), Counter(), Counter()
    for _, t in rows:
        x = (t or "").split()
        one.update(x)
        two.update(zip(x, x[1:]))
    for x in one:
        vocabulary[of[x]] += 1
    assert {k: n for k, n in enumerate(model.kinds.tolist()) if n} == vocabulary
    mass = Counter()
    for x, n in one.items():
        mass[of[x]] += n

    def by_hand(t, own):
        x, out = (t or "").split(), 0.0
        for k, y in enumerate(x):
            left, right = x[k - 1] if k else None, x[k + 1] if k + 1 < len(x) else None
            share = (max(0, one[y] - own) + 0.5) / (max(0, mass[of[y]] - own) + 0.5 * (vocabulary[of[y]] + 1))
            at = lambda j: model.classes.kind[of[x[j]]] if 0 <= j < len(x) else 0
            first = math.exp(table[at(k - 1), at(k + 1), at(k - 2), at(k + 2), of[y]]) * share
            pairs = sum(max(0, two[p] - own) for p in ((left, y), (y, right)) if None not in p)
            places = sum(max(0, one[z] - own) for z in (left, right) if z)
            weight = lm_score.PRIOR + lm_score.SPREAD * places**lm_score.GROWTH
            out += math.log((pairs + weight * first) / (places + weight))
        return out

    for df, want, own in ((docs, rows, 1), (other, held, 0)):
        got = {r.doc_id: r for r in lm_score.score(df, model).collect()}
        assert len(got) == len(want)
        for i, t in want:
            assert got[i].log_likelihood == pytest.approx(by_hand(t, own), abs=2e-3), i
    assert got[1].log_likelihood > got[2].log_likelihood + 1  # order within a class matters


def test_lm_beats_word_frequencies(spark):
    """On real texts, each token judged without its own place: far better than by its frequency alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"])
    got = lm_score.score(docs, lm_score.fit(docs)).agg({"log_likelihood": "sum", "n_tokens": "sum"}).first()
    words = [w for r in docs.select("text").collect() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))]
    count = Counter(words)
    total, kinds = len(words), len(count)
    alone = sum(n * math.log((n - 1 + 0.5) / (total - 1 + 0.5 * (kinds + 1))) for n in count.values()) / total
    mean = got["sum(log_likelihood)"] / got["sum(n_tokens)"]
    print("per token:", round(mean, 3), "frequency alone:", round(alone, 3))
    assert mean > alone + 1
