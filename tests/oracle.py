"""Compare a Spark result with DuckDB SQL, row for row."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(data: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = _bag(result.fetchall(), want_columns)
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    got = _bag((tuple(r) for r in df.collect()), df.columns)
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"{sum(extra.values())} extra e.g. {list(extra)[:2]}; "
            f"{sum(missing.values())} missing e.g. {list(missing)[:2]}")
