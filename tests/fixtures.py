"""Small hand-written rows."""

from __future__ import annotations

from datetime import datetime

from metaloom import fixed_values as fv, schemas
from metaloom.sources.tables import conform, typed_rows

UUID_A = "0a1b2c3d-4e5f-6071-8293-a4b5c6d7e8f9"
UUID_B = "ffffffff-4e5f-6071-8293-a4b5c6d7e8f9"


def inventory(spark, *rows):
    """Rows of (catalog id, schema id, table id, catalog, schema, table)."""
    return typed_rows(
        spark, [(*r, f"s3://x/{r[2]}", "MANAGED") for r in rows], schemas.INVENTORY
    )


def metadata(spark, *rows):
    """Rows as dicts of metadata columns; the rest is NULL."""
    columns = sorted({name for row in rows for name in row})
    types = [schemas.METADATA[c] for c in columns]
    from pyspark.sql.types import StructType

    df = spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], StructType(types))
    return conform(df, schemas.METADATA)


def named(record_id, *names, **more):
    return {
        fv.RECORD_ID: record_id,
        **dict(zip(schemas.SOURCE_NAMES, names)),
        **more,
    }


def tags(spark, *rows):
    return typed_rows(spark, rows, schemas.TAGS)


def status(spark, *rows):
    """Rows of (record id, account, status, message, day of January 2024)."""
    return typed_rows(
        spark, [(*r[:4], datetime(2024, 1, r[4])) for r in rows], schemas.STATUS
    )


def by(df, key):
    """Rows as dicts under one column's value."""
    return {row[key]: row.asDict() for row in df.collect()}


def bag(df, *columns):
    return sorted(
        (tuple(r) for r in (df.select(*columns) if columns else df).collect()),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )
