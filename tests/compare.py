"""Rows of a DataFrame against rows of DuckDB SQL over the same tables."""

import glob
import os

import duckdb
import pandas as pd


def connect(folder):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(p)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(x):
    if isinstance(x, (list, tuple)) or (hasattr(x, "tolist") and hasattr(x, "__len__")):
        return [plain(v) for v in x]
    if isinstance(x, dict):
        return {k: plain(v) for k, v in x.items()}
    if x is None or (not isinstance(x, str) and pd.isna(x)):
        return None
    if isinstance(x, str) or type(x).__name__ in ("bool", "bool_"):
        return x if isinstance(x, str) else bool(x)
    try:
        return float(x) + 0.0
    except (TypeError, ValueError):
        return x


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(repr([plain(v) for v in r]) for r in df.itertuples(index=False))


def assert_same(made, expected):
    assert sorted(made.columns) == sorted(expected.columns)
    assert rows(made) == rows(expected)
