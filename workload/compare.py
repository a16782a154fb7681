"""Compare a Spark query with its SQL on the same Parquet tables."""

from __future__ import annotations

import math
import time

import duckdb
import pandas as pd

from workload.tables import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the given tables as views."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(f"{float(value):.10g}")
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    ordered = frame[sorted(frame.columns)]
    return sorted((tuple(map(_plain, row)) for row in ordered.itertuples(index=False, name=None)), key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    """True with a timing, or False with the first differences."""
    begin = time.time()
    ours = query(spark, sf_dir).toPandas()
    spent = time.time() - begin
    theirs = con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return False, f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    a, b = rows_of(ours), rows_of(theirs)
    if a == b:
        return True, f"{len(a)} rows, {spent:.1f}s"
    only_a, only_b = [r for r in a if r not in b][:4], [r for r in b if r not in a][:4]
    return False, f"{len(a)} / {len(b)} rows\n   spark only {only_a}\n   sql only {only_b}"
