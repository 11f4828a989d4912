"""Every query of the subpackage runs over its whole table and agrees with its SQL, where it has one."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from punctual.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    ours, theirs = (df[columns].sort_values(columns, ignore_index=True) for df in (ours, theirs))
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, check_exact=True)


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
