"""Compare a Spark result with the result of SQL in DuckDB, order-insensitively."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([str(r[i]) for i in order] for r in rows))


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())


def difference(df, con, sql):
    """None if equal, else a short text."""
    columns, got = spark_rows(df)
    wanted_columns, wanted = sql_rows(con, sql)
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if got == wanted:
        return None
    a, b = set(map(tuple, got)), set(map(tuple, wanted))
    return f"rows {len(got)} vs {len(wanted)}; only here {sorted(a - b)[:3]}; only in SQL {sorted(b - a)[:3]}"
