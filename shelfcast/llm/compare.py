"""Compares the subpackage's queries with their SQL: python -m shelfcast.llm.compare FOLDER [query ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

from shelfcast.llm.oracle import ORACLE
from shelfcast.llm.queries import QUERIES
from shelfcast.session import local_session


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name} as select * from read_parquet('{files}')")
    return con


def rows(columns: list[str], values) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(v[i] for i in order) for v in values), key=repr)


def difference(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(set(names) ^ set(frame.columns))}"
    expected, got = rows(names, cursor.fetchall()), rows(frame.columns, map(tuple, frame.collect()))
    if len(got) != len(expected):
        return f"rows: {len(got)} against {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected, strict=True) if g != e]
    return f"{len(wrong)} rows, first {str(wrong[0])[:600]}" if wrong else None


def main(folder: str, names: list[str]) -> int:
    spark = local_session(8)
    con, failed = connect(folder), 0
    for name in names or list(QUERIES):
        began = time.time()
        frame = QUERIES[name](spark, folder)
        if name in ORACLE:
            found = difference(frame, con, ORACLE[name])
            note = "equal" if found is None else f"DIFFERENT {found}"
            failed += found is not None
        else:
            note = f"rows only: {frame.count()}"
        print(f"{time.time() - began:7.2f}s  {name}: {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
