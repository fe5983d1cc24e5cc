"""Compare a query's rows with those of DuckDB on the same files."""

import os

import duckdb
import pandas as pd


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object and df[c].map(lambda x: hasattr(x, "isoformat")).any() or str(df[c].dtype).startswith("datetime"):
            df[c] = pd.to_datetime(df[c])
        elif df[c].dtype.kind in "fiu":
            df[c] = df[c].astype(float).round(5)
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def check(spark, run, sql, sf):
    got = run(spark, sf).toPandas()
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    want = con.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(normal(got), normal(want), check_dtype=False, atol=2e-5, rtol=1e-9)
