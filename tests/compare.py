"""Order-insensitive, exact comparison of a Spark result with the SQL check."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def oracle(sf_dir: str, sql: str):
    con = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        files = f"{table}/*.parquet" if table.is_dir() else table
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{files}')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    return names, kinds, cursor.fetchall()


def assert_same(df, sf_dir: str, sql: str) -> int:
    names, kinds, rows = oracle(sf_dir, sql)
    assert df.columns == names
    assert [KINDS[kind] for _, kind in df.dtypes] == kinds
    ours = Counter(tuple(row) for row in df.collect())
    theirs = Counter(tuple(row) for row in rows)
    assert ours == theirs, (list((ours - theirs).items())[:5], list((theirs - ours).items())[:5])
    return len(rows)
