"""Run a registered query and its SQL on the same files and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) or hasattr(value, "dtype") and value.dtype.kind == "f":
        return float(value) + 0.0
    if hasattr(value, "item"):
        return value.item()
    if hasattr(value, "to_pydatetime"):
        return value.to_pydatetime()
    return value


def rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    records = [tuple(_cell(v) for v in r) for r in frame[columns].itertuples(index=False)]
    return sorted(records, key=repr)


def planned(df) -> str:
    """Text of the physical plan."""
    return df._jdf.queryExecution().executedPlan().toString()
