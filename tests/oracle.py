"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and the multiset of rows (columns sorted by
name, rows sorted)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).to_datetime64().astype("datetime64[us]").item() if v.tzinfo else v.to_datetime64().astype("datetime64[us]").item()
    if hasattr(v, "item"):
        return v.item()
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.sql(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row count differs: spark={len(s)} oracle={len(o)}"
    rs, ro = rows(s), rows(o)
    bad = [(a, b) for a, b in zip(rs, ro) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(s)} rows match"
