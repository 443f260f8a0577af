"""Compare a Spark query with DuckDB SQL on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for p in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        at = p if os.path.isfile(p) else f"{p}/*.parquet"
        c.execute(f"create view {os.path.basename(p).removesuffix('.parquet')} as select * from read_parquet('{at}')")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "~"
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        if isinstance(v, float):
            return f"{v:.6f}" if v != int(v) else str(int(v))
        return str(v)

    cols = sorted(df.columns)
    return sorted(tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False, name=None))


def same(spark_df, sql: str, c: duckdb.DuckDBPyConnection) -> None:
    a, b = spark_df.toPandas(), c.execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    x, y = rows(a), rows(b)
    assert len(x) == len(y), (len(x), len(y))
    bad = [(p, q) for p, q in zip(x, y, strict=True) if p != q]
    assert not bad, bad[:3]
