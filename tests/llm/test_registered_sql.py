"""Corpus queries that SQL can express, against it in another engine on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from quern.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = c.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF).toPandas()[list(want.columns)]
    order = lambda df: df.sort_values(list(df.columns)).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
    assert want["contaminated"].any()
