"""Rows of a query against rows of its SQL, in the driver's manner."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def spark_rows(df) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(v) for v in r) for r in df.select(*cols).collect())


def oracle_rows(con, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
    return [names[i] for i in order], rows
