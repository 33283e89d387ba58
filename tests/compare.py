"""Compare a Spark result with DuckDB's, as text, without regard to order."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(str(r[c]) for c in columns) for r in df.collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, Counter(tuple(str(r[i]) for i in at) for r in result.fetchall())
