"""Every registered query of the record engine against DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from docengine.oracles import ORACLES
from docengine.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(frame):
    def cell(v):
        if v is None or v is pd.NA or v != v:
            return "null"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return sorted(tuple(map(cell, row)) for row in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want, got = con.sql(ORACLES[name]).df(), QUERIES[name](spark, DATA).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    assert plain(want) == plain(got)
