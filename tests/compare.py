"""Order-insensitive comparison of a Spark result with a SQL result."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    want = _bag(names, cursor.fetchall())
    got = _bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got == want:
        return None
    return (
        f"{sum(got.values())} and {sum(want.values())} rows; "
        f"only Spark {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}"
    )
