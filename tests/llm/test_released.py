"""What a task leaves behind in its Python worker, which lives on beside all later ones of its executor."""

import numpy as np
import pytest

from postatlas.llm import queries, sentencepiece_codec, textcore

PIECE = queries.tokenizer("piece_bpe_32k.model")


def left_behind(batches):
    import pyarrow as pa

    for _ in batches:
        pass
    codec = sentencepiece_codec._codec(PIECE, sentencepiece_codec.load(PIECE))
    yield pa.RecordBatch.from_pydict({"known": [len(codec.known)], "hits": [sentencepiece_codec._codec.cache_info().hits], "powers": [len(textcore._powers)]})


def test_tasks_leave_no_tables(spark):
    docs = spark.createDataFrame([(i, " ".join(f"word{i * 50 + k}" for k in range(50))) for i in range(400)], "doc_id long, text string").coalesce(1)
    assert sentencepiece_codec.token_digests(docs, PIECE).agg({"n_tokens": "sum"}).first()[0] > 0
    found = spark.range(64).repartition(8).mapInArrow(left_behind, "known long, hits long, powers long").collect()
    assert max(r.known for r in found) == 0
    assert max(r.powers for r in found) == 1


def test_power_tables_go_and_come_back():
    symbols = np.arange(300_000, dtype=np.uint8)
    before = textcore.Spans(symbols).windows(50)
    assert len(textcore._powers) > 300_000
    assert list(textcore.tidied(iter)([1, 2])) == [1, 2]
    assert len(textcore._powers) == len(textcore._inverse_powers) == 1
    assert (textcore.Spans(symbols).windows(50) == before).all()


@pytest.mark.parametrize("limit", [1, 200_000, 1 << 40])
def test_segment_table_is_bounded_by_bytes(monkeypatch, limit):
    rng = np.random.default_rng(3)
    batches = [[" ".join("".join(rng.choice(list("abcdefgh"), 2000)) for _ in range(10)) for _ in range(3)] for _ in range(6)]
    plain = sentencepiece_codec.Codec(sentencepiece_codec.load(PIECE))
    want = [plain.digests(b) for b in batches]
    bounded = sentencepiece_codec.Codec(sentencepiece_codec.load(PIECE))
    monkeypatch.setattr(sentencepiece_codec, "TABLE_BYTES", limit)
    most, got = 0, []
    for b in batches:
        got.append(bounded.digests(b))
        most = max(most, sum(map(len, bounded.known)))
    assert got == want
    assert most == sum(map(len, plain.known)) if limit > 1 << 30 else most < limit + 70_000
