"""Order-insensitive comparison of a Spark result with a DuckDB result.

Used by the tests (and handy by hand): both sides become pandas frames with
columns sorted by name; rows are sorted; floats are compared rounded.
"""

from __future__ import annotations

import math
import os

import pandas as pd

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")


def duckdb_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    import duckdb
    con = duckdb.connect()
    for t in RAW_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con.sql(sql).df()


def _norm_value(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return None
        r = round(float(v), 6)
        return int(r) if r.is_integer() else r
    return v


def canonical_rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm_value(v) for v in rec))
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, sql: str, sf_dir: str) -> dict:
    left = spark_df.toPandas()
    right = duckdb_frame(sql, sf_dir)
    out = {"rows_spark": len(left), "rows_oracle": len(right),
           "cols_spark": sorted(left.columns), "cols_oracle": sorted(right.columns)}
    out["rows_match"] = len(left) == len(right)
    out["cols_match"] = out["cols_spark"] == out["cols_oracle"]
    out["values_match"] = out["cols_match"] and canonical_rows(left) == canonical_rows(right)
    return out
