"""Compare a Spark result with the same query's SQL result, regardless of row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())
