"""Every registered query runs, and agrees with its SQL where it has one."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from conftest import SF
from punctual.plans.catalogue import ORACLES, QUERIES

SLOW_MODELS = {"leak_steps", "sampler_models", "feature_sets", "rare_class_models", "saved_model", "model_slices", "model_violations"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object or str(df[c].dtype).startswith("str"):
            df[c] = df[c].map(lambda v: None if v is None or v != v else str(v))
    return df.sort_values(list(df.columns), na_position="last").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW_MODELS))
def test_agrees_with_sql(spark, duck, name):
    ours = normal(QUERIES[name](spark, SF).toPandas())
    theirs = normal(duck.sql(ORACLES[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=1e-12)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW_MODELS))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
