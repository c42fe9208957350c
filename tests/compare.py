"""Comparison of a query with its SQL, as sorted rows."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def value(x):
    if x is None or (isinstance(x, float) and pd.isna(x)) or x is pd.NA:
        return None
    if isinstance(x, bool):
        return x
    return float(x) if isinstance(x, (int, float)) else x


def rows(frame, columns):
    return sorted(repr(tuple(value(x.item() if hasattr(x, "item") else x) for x in r)) for r in frame[columns].itertuples(index=False, name=None))


def same(spark, con, query, sql, sf_dir):
    ours, theirs = query(spark, sf_dir).toPandas(), con.sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    assert rows(ours, columns) == rows(theirs, columns)
