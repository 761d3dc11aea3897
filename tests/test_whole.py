"""Post queries read the whole text: held against brute force, on a small fixture and on the smallest tables."""

import datetime as dt

from postatlas.plans import catalog
from postatlas.plans.posts import NAMES
from postatlas.sources.gazetteer import rows
from tests.conftest import SF


def best(haystack):
    """(ord, score) of the best place of a text, or None."""
    found = [(prio * 100 + len(name), -o) for o, names, _, _, _, _, kind, prio in rows() for name in [next((n for n in names if n in haystack), None)] if name]
    return (-max(found)[1], max(found)[0]) if found else None


def test_place_names_far_into_the_text(spark, tmp_path):
    texts = ["x " * 150 + "博多 end", "y" * 199 + "札幌", "z" * 5000 + " 京都市 " + "z" * 5000, "no place " * 60]
    ids = [10 + 210 * k for k in range(len(texts))]  # no name is added to these, and they have no geotag
    spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in zip(ids, texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, dt.datetime(2024, 1, 1), 1) for i in ids], "event_id long, ts timestamp, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    want = {i: best(f"{t} en web") for i, t in zip(ids, texts)}
    assert sum(x is not None for x in want.values()) == 3
    got = {r.ord: (r.gord, r.score) for r in catalog.QUERIES["gazetteer_match"](spark, str(tmp_path)).collect()}
    assert got == {i: x for i, x in want.items() if x}
    shown = {r.id: r.text for r in catalog.QUERIES["located_posts"](spark, str(tmp_path)).collect()}
    assert shown == {f"doc:{i}": t for i, t in zip(ids, texts) if want[i]}
    assert catalog.QUERIES["post_counts"](spark, str(tmp_path)).first().located == 3


def test_whole_texts_of_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    events = {r.event_id for r in spark.read.parquet(f"{SF}/events.parquet").select("event_id").collect()}
    text = {d.doc_id: d.text + (" " + NAMES[d.doc_id % len(NAMES)] if d.doc_id % 5 else "") for d in docs if d.doc_id in events}
    want = {d.doc_id: best(f"{text[d.doc_id]} {d.lang} {d.source}") for d in docs if d.doc_id in text and d.doc_id % 7}
    got = {r.ord: (r.gord, r.score) for r in catalog.QUERIES["gazetteer_match"](spark, SF).collect()}
    assert got == {i: x for i, x in want.items() if x}
    assert {r.id: r.text for r in catalog.QUERIES["located_posts"](spark, SF).collect()}.items() <= {f"doc:{i}": t for i, t in text.items()}.items()
