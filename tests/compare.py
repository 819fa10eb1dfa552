"""Comparison of a query with its SQL counterpart in DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), rows_of(columns, cur.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())
