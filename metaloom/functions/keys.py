"""Hashed keys of a table and its integration."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from metaloom import fixed_values as fv

MIN_LONG = -(2**63)


def non_negative_hash(*parts: Column) -> Column:
    """Absolute 64-bit hash of ``parts``; NULL if a part is NULL.

    The hash function skips NULLs, which would make different keys collide. The smallest
    long has no absolute value and maps to 0.
    """
    complete = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    hashed = F.xxhash64(*parts)
    return F.when(
        complete, F.when(hashed == F.lit(MIN_LONG), F.lit(0).cast("long")).otherwise(F.abs(hashed))
    )


def record_id() -> Column:
    """Key of a metadata record. Derived from ids, so it survives renames."""
    return non_negative_hash(F.col(fv.CATALOG_ID), F.col(fv.SCHEMA_ID), F.col(fv.TABLE_ID))


def integration_name() -> Column:
    """Name of the integration that serves a schema."""
    return F.concat(
        F.lit(fv.INTEGRATION_PREFIX),
        non_negative_hash(F.col(fv.CATALOG_ID), F.col(fv.SCHEMA_ID)).cast("string"),
    )
