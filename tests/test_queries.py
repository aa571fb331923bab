"""Every query against its SQL in another engine, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from quern.plans import analysis, catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = {**catalog.QUERIES, **analysis.QUERIES}
ORACLES = {**catalog.ORACLES, **analysis.ORACLES}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    cell = lambda x: None if pd.isna(x) else round(float(x), 9) if isinstance(x, float) else str(x)
    return sorted((tuple(cell(x) for x in r) for r in df.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)


def test_registry_is_complete():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
