"""Spark-vs-DuckDB result comparison (row count, column names, value hash)."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

from encore.sources.tables import TABLES


def duck_connection(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    h = hashlib.sha256(repr(rows).encode()).hexdigest()
    return len(rows), cols, h


def compare(spark_df, con, sql: str) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    sn, sc, sh = frame_digest(s)
    dn, dc, dh = frame_digest(d)
    return {"rows_spark": sn, "rows_oracle": dn, "cols_match": sc == dc, "hash_match": sh == dh,
            "cols_spark": sc, "cols_oracle": dc}
