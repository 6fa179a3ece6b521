"""Keyed rows, ready for a merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.functions.keys import integration_name, record_id
from metaloom.sources.tables import conform


def keyed(inventory: DataFrame) -> DataFrame:
    """Inventory rows as metadata rows: hashed keys, and typed NULLs for what no sync set yet."""
    rows = inventory.select(
        "*",
        record_id().alias(fv.RECORD_ID),
        integration_name().alias(fv.INTEGRATION),
        *(F.lit(None).cast(schemas.METADATA[c].dataType).alias(c) for c in schemas.SYNC),
    )
    return conform(rows, schemas.METADATA)
