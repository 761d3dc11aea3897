"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

from postatlas.plans import captured, catalog  # noqa: F401  (captured registers its queries in catalog)
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def shape(rows):
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert shape(tuple(r) for r in got.select(*columns).collect()) == shape(want)


def test_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.queries()["stream_window_dedupe"](spark, SF).count() > 0
