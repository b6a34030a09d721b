"""A query and its SQL over the same tables."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool | str):
        return str(v)
    return str(round(float(v), 6))


def normal(df):
    rows = df[sorted(df.columns)].map(_cell)
    return sorted(map(tuple, rows.itertuples(index=False)))


def same(spark_df, con, sql):
    a, b = spark_df.toPandas(), con.sql(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert normal(a) == normal(b)
    return len(a)
