"""Runs registered queries in Spark and their SQL in DuckDB and compares whole results.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from checks.oracle import ORACLE
from checks.queries import QUERIES
from shelfcast.session import local_session
from shelfcast.sources.fixtures import RetailInputs

_SPARK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set threads = 8")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if frame[name].dtype == object or str(frame[name].dtype).startswith(("datetime", "str")):
            frame[name] = frame[name].map(lambda v: None if pd.isna(v) else str(v)[:10] if hasattr(v, "year") else str(v))
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns, types, row count and values agree, else what differs first."""
    cursor = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetch_df()
    types = {n: _SPARK_TYPES.get(t, t) for n, t in spark_df.dtypes}
    if types != expected_types:
        return f"columns or types: {sorted(set(types.items()) ^ set(expected_types.items()))}"
    got = spark_df.toPandas()
    if len(got) != len(expected):
        return f"rows: {len(got)} against {len(expected)}"
    got, expected = _sorted(got), _sorted(expected)
    for name in got.columns:
        a, b = got[name], expected[name]
        equal = (a == b) | (a.isna() & b.isna())
        if not equal.all():
            at = equal.idxmin()
            return f"{name}: {(~equal).sum()} cells, first {a[at]!r} against {b[at]!r}"
    return None


def main(folder: str, names: list[str]) -> int:
    spark = local_session(8)
    con = connect(folder)
    failed = 0
    for name in names or list(QUERIES):
        began = time.time()
        frame = QUERIES[name](RetailInputs(spark, folder))
        if name in ORACLE:
            try:
                found = difference(frame, con, ORACLE[name])
            except Exception as error:
                found = f"{type(error).__name__}: {str(error)[:400]}"
            note = "equal" if found is None else f"DIFFERENT {found}"
            failed += found is not None
        else:
            note = f"rows only: {frame.count()}"
        print(f"{time.time() - began:7.2f}s  {name}: {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
