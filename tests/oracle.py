"""Spark results against DuckDB's, without regard to row order or column order."""

from __future__ import annotations

import os

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value):
    if value is None or value is pd.NA or value != value:
        return None
    if isinstance(value, bool | np.bool_):
        return bool(value)
    if isinstance(value, int | float | np.number):
        return round(float(value), 9)
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple]:
    names = sorted(frame.columns)
    return sorted((tuple(plain(v) for v in row) for row in frame[names].astype(object).itertuples(index=False)), key=str)


def check(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    mine, theirs = df.toPandas(), con.sql(sql).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)
