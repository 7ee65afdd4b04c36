"""Every registered query of the market-evidence operators against its oracle, on the smallest tables."""

import math

import duckdb
import pytest
from pyspark.sql import Row

from marketlens.plans import registry
from marketlens.sources.tables import TABLES
from tests.conftest import SF

QUERIES, ORACLES = registry.queries(), registry.oracles()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (bool, str)):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple, Row)):
        return tuple(plain(x) for x in v)
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name in ORACLES:
        r = con.execute(ORACLES[name])
        columns = [c[0] for c in r.description]
        assert sorted(columns) == sorted(df.columns)
        assert table(df.columns, rows) == table(columns, r.fetchall())
