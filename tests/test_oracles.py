"""Every query with an oracle equals it on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


def rows(f):
    def cell(v):
        if pd.isna(v):
            return None
        return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    cols = sorted(f.columns)
    return cols, sorted((tuple(map(cell, r)) for r in f[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    assert rows(entry.queries()[name](spark, SF).toPandas()) == rows(c.execute(ORACLES[name]).df())
