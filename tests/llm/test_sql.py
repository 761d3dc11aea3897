"""The queries of this subpackage against their SQL on the smallest tables."""

import duckdb
import pytest

from postatlas.llm import queries
from tests.conftest import SF


def shape(rows):
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = c.sql(f"SELECT {', '.join(chr(34) + x + chr(34) for x in columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert shape(tuple(r) for r in got.select(*columns).collect()) == shape(want)
