"""Entity tables: what is known about a catalog, schema or table beyond its name.

Landed entity tables may hold copies of a row. They are folded to one row per name before
any join, with map-side combining, so a much-copied entity neither fans out nor skews the
join. Copies that disagree are marked, not picked from; they are told apart by 64-bit hashes,
so that one copy of the facts is shuffled, not two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metaloom.functions.attributes import uuid_in


def _one_per_name(entities: DataFrame, names: tuple[str, ...], values: tuple[str, ...], flag: str):
    # a hash skips NULLs, so which values are NULL goes into it too
    mark = F.xxhash64(*values, *(F.col(v).isNull() for v in values))
    folded = entities.groupBy(*names).agg(
        F.min(F.struct(*values)).alias("facts"), F.min(mark).alias("low"), F.max(mark).alias("high")
    )
    return folded.select(*names, "facts.*", (F.col("low") != F.col("high")).alias(flag))


def catalog_entities(catalogs: DataFrame) -> DataFrame:
    """``catalog_name, catalog_id``; the id comes from the storage location."""
    ids = catalogs.select("catalog_name", uuid_in(F.col("storage_location")).alias("catalog_id"))
    return _one_per_name(ids, ("catalog_name",), ("catalog_id",), "catalog_conflict")


def schema_entities(schemas: DataFrame) -> DataFrame:
    """``catalog_name, schema_name, schema_id``."""
    return _one_per_name(
        schemas, ("catalog_name", "schema_name"), ("schema_id",), "schema_conflict"
    )


def table_entities(tables: DataFrame) -> DataFrame:
    """``catalog_name, schema_name, table_name, table_id, storage_location, table_type``."""
    return _one_per_name(
        tables,
        ("catalog_name", "schema_name", "table_name"),
        ("table_id", "storage_location", "table_type"),
        "table_conflict",
    )
