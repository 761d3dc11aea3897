"""Lines that very many different lines share a half or a variant with."""

import numpy as np
import pyarrow as pa

from postatlas.llm import line_dedup
from postatlas.llm.stretches import _kinds
from postatlas.llm.textcore import unpack_all

from . import plain

HOT = [(i, f"dear user number{i} you have one new message in the box\nfrom the desk of person{i} with {i % 3} regards to you all") for i in range(60)]
HOT += [(100 + i, f"dear user you have one new message in the box\nalone {i} at night\n" + "dear user number7 you have one new message in the box") for i in range(3)]
HOT += [(200, "from the desk of person5 with 1 regards to you all"), (201, "dear kind user number3 you have one new message in the box"), (202, None)]


def test_against_plain(spark):
    for parts in (1, 7):
        df = spark.createDataFrame(HOT, "doc_id long, text string").repartition(parts)
        got = line_dedup.digests(df).orderBy("doc_id").collect()
        assert [tuple(r[c] for c in ("doc_id", "n_lines", "n_removed", "kept_sha256")) for r in got] == plain.lines(HOT)


def test_exchanges_combine_first():
    docs = pa.table({"doc_id": pa.array([r[0] for r in HOT], pa.int64()), "text": pa.array([r[1] for r in HOT])})
    kinds = _kinds(pa.Table.from_batches(line_dedup._scan(1, 8)(docs.to_batches())))
    half = unpack_all(kinds[line_dedup.HALF], *line_dedup._HALF)[0]
    assert np.unique(half, return_counts=True)[1].max() == 2  # whatever the number of lines that share it
    asked = line_dedup._settle(1)(pa.Table.from_batches(line_dedup._scan(1, 8)(docs.to_batches())))
    kinds = _kinds(line_dedup._emit(1, 8)(docs, asked))
    key, place, _, _ = unpack_all(kinds[line_dedup.VARIANT], *line_dedup._VARIANT)
    assert np.unique(np.stack([key, place.astype(np.uint64)]), axis=1, return_counts=True)[1].max() == 1
    assert len(unpack_all(kinds[line_dedup.LINK], *line_dedup._LINK)[0]) >= 59 + 57
