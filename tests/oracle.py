"""Comparison of a query with its SQL in DuckDB."""

import glob
import math
import os

import duckdb
import pandas as pd


def connect(folder: str):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{folder}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def norm(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return None if math.isnan(v) else format(round(v, 9), ".9g")
    if isinstance(v, int):
        return format(float(v), ".9g") if abs(v) < 2**50 else str(v)
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted((tuple(norm(x) for x in r) for r in df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)), key=str)
