"""Compare a Spark result with the second engine's, ignoring row order."""

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
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    table = con.sql(sql).to_arrow_table()
    return _rows(table.column_names, [tuple(r.values()) for r in table.to_pylist()])


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def _rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(repr(r[i]) for i in order) for r in rows)


def difference(spark_result, oracle_result) -> str | None:
    """None if equal, else a short account of what differs."""
    (columns, ours), (oracle_columns, theirs) = spark_result, oracle_result
    if columns != oracle_columns:
        return f"columns {sorted(set(columns) ^ set(oracle_columns))}"
    extra, lacking = ours - theirs, theirs - ours
    if not extra and not lacking:
        return None
    a, b = next(iter(extra), ()), next(iter(lacking), ())
    near = min(lacking, key=lambda r: sum(x != y for x, y in zip(a, r)), default=b) if a else b
    cells = [(c, x, y) for c, x, y in zip(columns, a, near) if x != y][:5]
    return f"{ours.total()} vs {theirs.total()} rows; +{extra.total()} -{lacking.total()}; e.g. {cells or (a, b)}"
