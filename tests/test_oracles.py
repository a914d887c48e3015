"""Every registered query against its SQL on a second engine, on the smallest tables."""

import datetime

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_points

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal_form(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if not pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].map(lambda v: v.isoformat()[:10] if isinstance(v, datetime.date) else str(v))
    exact = [c for c in df.columns if not pd.api.types.is_float_dtype(df[c])]
    return df.sort_values(exact + [c for c in df.columns if c not in exact]).reset_index(drop=True)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, sf_dir):
    assert entry_points.entry(spark).count() == 6


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    duck.execute(SQL[name])
    want = duck.fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = normal_form(got), normal_form(want)
    assert len(got) == len(want)
    for c in got.columns:
        if pd.api.types.is_float_dtype(got[c]) or pd.api.types.is_float_dtype(want[c]):
            np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=0, err_msg=c)
        else:
            assert got[c].astype(str).tolist() == want[c].astype(str).tolist(), c
