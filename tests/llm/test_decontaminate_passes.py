"""Several passes over the benchmark judge rows of one id and one length apart, as one pass does."""

import pytest

from postatlas.llm import decontaminate


@pytest.mark.parametrize("size", [1 << 24, 60])
def test_rows_of_one_id_and_length(spark, size):
    items = [(k, " ".join(f"{x}{k}" for x in "abcdefgh")) for k in range(6)]
    rows = [(None, items[0][1]), (None, items[3][1]), (None, "n o t h i n g s"), (7, items[1][1]), (7, items[2][1]), (7, items[2][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.judged(decontaminate.find_matches(docs, bench, pass_bytes=size))
    assert sorted((r.doc_id or 0, r.n_hit, r["items"]) for r in got.collect()) == [(0, 0, []), (0, 8, ["0"]), (0, 8, ["3"]), (7, 8, ["1"]), (7, 8, ["2"]), (7, 8, ["2"])]


@pytest.mark.parametrize("size", [1 << 24, 60])
def test_affected_documents_go(spark, size):
    items = [(k, " ".join(f"{x}{k}" for x in "abcdefgh")) for k in range(6)] + [(None, "q r s t u v w x")]
    rows = [(None, f"x {items[0][1]} y", 1), (None, None, 2), (3, "clean words only", 3), (4, items[1][1] + " " + items[2][1], 4), (5, items[3][1].upper(), 5), (5, "another text of five", 6), (6, "q r s t u v w x", 7), (7, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _items int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for least, gone in ((1, {1, 4, 5}), (2, {4})):
        kept = decontaminate.decontaminate(docs, bench, min_items=least, pass_bytes=size)
        assert kept.schema == docs.schema
        assert {r["_items"] for r in kept.collect()} == {r[2] for r in rows} - gone
    got = {r.n_words: (r.n_hit, r["items"]) for r in decontaminate.judged(decontaminate.find_matches(docs.where("doc_id = 6"), bench, pass_bytes=size)).collect()}
    assert got == {8: (8, [])}  # an item without an id hits words only
