"""Every catalog query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

from mailgrove.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _plain(v):
    if v is None or v != v:
        return None
    return round(v, 6) if isinstance(v, float) and math.isfinite(v) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in catalog.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rows = sorted(str([_plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    if name in catalog.oracle_sql():
        got = duck.execute(catalog.oracle_sql()[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted(str([_plain(dict(zip(names, r, strict=True))[c]) for c in sorted(names)]) for r in got.fetchall())
        assert rows == want
    else:
        assert rows
