"""Each operator against its plain version, on real rows and on edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postatlas.llm import components, decontaminate, line_dedup, lm_score, ngram_join, quality, queries, sentencepiece_codec, substring_dedup, suffix_dedup, token_counts, url_filter
from tests.conftest import SF

from . import plain

SCHEMA = "doc_id long, text string, lang string, b string, kind int"


def texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5)))
    base = [word() for _ in range(400)]
    passage = " ".join(rnd.choice(base) for _ in range(70))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "a b c"), (6, "A b  c"), (7, "xy " * 300), (8, "z" * 900)]
    for i in range(10, 40):
        w = [rnd.choice(base) for _ in range(rnd.randint(3, 160))]
        if i % 3 == 0:
            w[len(w) // 2 : len(w) // 2] = passage.split()
        rows.append((i, "".join(x + rnd.choice([" ", " ", " ", "\n"]) for x in w)))
    for k, (i, t) in enumerate(rows[10:24]):  # near copies, from one to three words changed
        w = t.split(" ")
        for _ in range(k % 4):
            w[rnd.randrange(len(w))] = word()
        rows.append((60 + k, " ".join(w)))
    small = "p q r s t u v w x y z".split()
    rows += [(80 + k, " ".join(small[: 6 + k % 5])) for k in range(8)] + [(90, " ".join(base) * 60), (91, " ".join(base) * 60 + " end")]
    return rows


ROWS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "clash", 1) for i, t in ROWS] + [(12, dict(ROWS)[12], "en", "clash", 1), (None, "no id at all", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


REPEATED = [*ROWS, (12, dict(ROWS)[12])]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.where("doc_id is not null").select(*columns).collect())


def test_suffix_dedup(docs):
    got = suffix_dedup.digests(docs)
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == plain.suffix(REPEATED)
    assert sorted(r.n_bytes for r in got.where("doc_id is null").collect()) == [0, 12]


def test_substring_dedup(docs):
    assert rows(substring_dedup.digests(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == plain.substring(REPEATED)
    small = substring_dedup.spec(group=7)  # many subtrees
    w = np.array([1, 2, 3, 4, 5, 6] * 30, np.uint64)
    for g in (small, substring_dedup.spec()):
        flag = g.index(w, np.array([0, 90]), np.array([90, 90]), np.array([1, 2]), np.array([0, 0]))
        assert not flag[:90].any() and flag[90:131].all()


def test_line_dedup(docs):
    assert rows(line_dedup.digests(docs), "doc_id", "n_lines", "n_removed", "kept_sha256") == plain.lines(REPEATED)
    assert line_dedup.drop_lines(docs).columns[:5] == docs.columns
    near = [(1, "a b c d e f g h i"), (2, "a b c d X f g h i\nother"), (3, "a b c d e f g h"), (4, "b a c d e f g h i")]
    df = docs.sparkSession.createDataFrame(near, "doc_id long, text string")
    assert rows(line_dedup.digests(df), "doc_id", "n_lines", "n_removed", "kept_sha256") == plain.lines(near)


def test_quality(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10, 40)] + [(None, 1, 0), (11, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(docs, quality.fit(docs, labels))
    names = [*quality.COUNTS, "base_failed"]
    assert rows(got, "doc_id", *names) == sorted(plain.counts(REPEATED))
    assert quality.keep_good(docs, None).count() == got.where("not base_failed").count()
    assert quality.fit(docs, labels.limit(0)) is None


def test_quality_held_out():
    import pandas as pd
    import pyarrow.parquet as pq

    from postatlas.llm.textcore import chunks

    d = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"])
    label = pd.read_parquet("/root/testdata/sf0.1/labels.parquet").set_index("doc_id").quality
    x, failed, ids = [], [], []
    for c in chunks(d.to_batches()):
        s = quality.statistics(c)
        x.append(quality._matrix(s))
        failed.append(quality.base_failed(s))
        ids.append(c.id_values)
    x, failed, ids = np.concatenate(x), np.concatenate(failed), np.concatenate(ids)
    use = ~failed & np.isin(ids, label.index)
    x, bad = x[use], label.reindex(ids[use]).to_numpy() == 0
    half = np.arange(len(x)) % 2 == 0
    forest = quality.train(x[half], bad[half])
    out = forest.score(x[~half]) > forest.threshold
    assert out[bad[~half]].mean() > 0.95 and out[~bad[~half]].mean() < 0.005


def test_sentencepiece(docs):
    import sentencepiece

    path = queries.tokenizer("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = [" ", "   a", "a  b ", "▁x", "\n", "\x00a", "é日本🍜", " <s> a</s>", "a\r\nb \t", "aaaaaaa ababab" + " " * 70]
    codec = sentencepiece_codec.Codec(sentencepiece_codec.load(path))
    all_texts = odd + [t or "" for _, t in ROWS]
    ids = codec.encode(all_texts)
    assert [list(x) for x in ids] == lib.encode(all_texts) and codec.decode(ids) == lib.decode([x.tolist() for x in ids])
    got = rows(sentencepiece_codec.token_digests(docs, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = [(i, len(e), plain.sha(",".join(map(str, e))), plain.sha(lib.decode(e))) for i, t in REPEATED for e in [lib.encode(t or "")]]
    assert got == sorted(want)


def test_token_counts(docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    odd = ["<|endoftext|>hello<|endoftext|>", "don't you'll  \n\n  x³½Ⅷ 　x\x85y", "🍜🍜 \t\t", "ⅧⅨ 123abc"]
    counter = token_counts.Counter(open(path, encoding="utf-8").read())
    assert counter.counts(odd) == [len(lib.encode(t, add_special_tokens=False).ids) for t in odd]
    got = rows(token_counts.count_tokens(docs, path, limit=100), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(i, len((t or "").encode()), n, n > 100) for i, t in REPEATED for n in [len(lib.encode(t or "", add_special_tokens=False).ids)]]
    assert got == sorted(want)


@pytest.mark.parametrize("size", [1 << 24, 300])
def test_decontaminate(spark, docs, size):
    t = dict(ROWS)
    items = [(1, " ".join((t[12] or "").split()[5:30])), (2, (t[12] or "").upper()), (3, "A b, C"), (4, None), (5, "..."), (10, t[15]), (2, t[20]), (6, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.judged(decontaminate.find_matches(docs, bench, pass_bytes=size))
    assert rows(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(plain.matches(REPEATED, items))
    kept = decontaminate.decontaminate(docs, bench, pass_bytes=size)
    assert kept.columns == docs.columns and kept.count() == docs.count() - got.where("n_items > 0").count()


def test_url_filter(spark):
    urls = ["http://www.example.com/en/1", "https://Example.COM/en/2?x=/fr/", "http://a.net/es/3", "http://com/x", "http://evilexample.com/en/1", "nothing", None, "", "http://h.org?q", "http://h.net/fr/#a", "s://notcom/en/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls * 3)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(got) == len(urls) * 3
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(11)] == [("www.example.com", "/en/1", "www.example.com/en/"), ("example.com", "/en/2", "example.com/en/"), ("a.net", "/es/3", "net/es/"), ("com", "/x", "com/"), ("evilexample.com", "/en/1", "com/"), ("", "", None), ("", "", None), ("", "", None), ("h.org", "", None), ("h.net", "/fr/", "net/fr/"), ("notcom", "/en/", None)]
    assert [got[i].verdict for i in (0, 1, 2, 3, 9)] == ["allow", "block", "block", "allow", "block"]
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_model_tells_classes(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    r = url_filter.judge(pages).where("rule is not null").groupBy("verdict").agg(F.avg("difference").alias("d")).collect()
    d = {x.verdict: x.d for x in r}
    assert d["allow"] > d["block"]


def test_lm_score(spark, docs):
    model = lm_score.fit(docs, epochs=20)
    got = lm_score.score(docs, model)
    assert got.count() == docs.count()
    assert np.allclose(np.exp(model.log_table.reshape(-1, lm_score.CLASSES).astype(float)).sum(1), 1, atol=1e-3)
    one = {r.doc_id: r for r in got.collect()}
    assert one[1].n_tokens == 0 and one[1].mean_log_likelihood is None and one[4].n_tokens == 1
    noise = spark.createDataFrame([(1, " ".join(random.Random(1).choice("qwrtz") * 9 for _ in range(200)))], "doc_id long, text string")
    assert lm_score.score(noise, model).first().mean_log_likelihood < one[90].mean_log_likelihood


def test_ngram_join(docs):
    assert rows(ngram_join.join_components(docs), "doc_id", "n_shingles", "component_id") == plain.components(REPEATED)
    kept = ngram_join.keep_one(docs)
    want = {c for _, _, c in plain.components(REPEATED)}
    assert {r.doc_id for r in kept.collect()} == {*want, None} and kept.columns == docs.columns


def test_ngram_join_large_groups(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(600)]
    base = [rnd.choice(words) for _ in range(150)]
    some = []
    for i in range(260):  # a drifting group, and texts that share a long common line
        w = list(base) if i < 150 else [*words[:30], *(rnd.choice(words) for _ in range(60))]
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        some.append((i, " ".join(w)))
    df = spark.createDataFrame(some, "doc_id long, text string").repartition(5)
    assert rows(ngram_join.join_components(df), "doc_id", "n_shingles", "component_id") == plain.components(some)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 75), (7, 7), (200, 200)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[75] == 50


def test_components_with_hubs(spark):
    """Two hubs with thousands of links, chains between their leaves, and a node of its own."""
    links = [(5000 + i, 9000) for i in range(3000)] + [(9000 + i, 12500) for i in range(3, 2500)] + [(5003, 3), (3, 2), (9000 + 7, 1), (20000, 20001), (20002, 20002)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        up[max(p, q)] = min(p, q)
    assert got == {x: root(x) for x in list(up)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (suffix_dedup.digests(none), substring_dedup.digests(none), line_dedup.digests(none), ngram_join.join_components(none), decontaminate.find_matches(none, bench), lm_score.score(none, lm_score.fit(none, epochs=1)), quality.judge(none, None)):
        assert df.count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    good = quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).where("kept")
    rows_ = [(r.doc_id, r.text) for r in docs.join(good.select("doc_id"), "doc_id").collect()]
    texts_ = {}
    cut = {i: s for i, _, _, s in plain.lines(rows_)}
    for r in line_dedup.drop_lines(docs.join(good.select("doc_id"), "doc_id")).collect():
        assert plain.sha(r.text) == cut[r.doc_id]
        if r.text.split():
            texts_[r.doc_id] = r.text
    keep = {c for _, _, c in plain.components(sorted(texts_.items()))}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {m[0] for m in plain.matches([(i, texts_[i]) for i in keep], items) if not m[3]}  # no item at all
    assert {r.doc_id for r in out.collect()} == want
