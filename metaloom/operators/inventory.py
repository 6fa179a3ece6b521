"""From listings and entities to the flat inventory of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from metaloom import fixed_values as fv
from metaloom.operators.joins import skew_safe_join
from metaloom.sources.entities import catalog_entities, schema_entities, table_entities

_SCHEMA_KEY = ["catalog_name", "schema_name"]
_TABLE_KEY = [*_SCHEMA_KEY, "table_name"]


def wanted_schemas(
    listed: DataFrame, include: str | Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Listed schemas to refresh: all but system schemas, or the ``include`` ones.

    ``include`` is a name, a list of names or a DataFrame with a ``schema_name`` column.
    An include list is taken at its word: it may name a system schema.
    """
    if include is None:
        return listed.filter(~F.col("schema_name").isin(*fv.SYSTEM_SCHEMAS))
    if isinstance(include, DataFrame):
        return listed.join(include.select("schema_name"), "schema_name", "left_semi").select(
            *listed.columns
        )
    names = [include] if isinstance(include, str) else list(include)
    return listed.filter(F.col("schema_name").isin(*names))


def look_up_schemas(
    listed_schemas: DataFrame, catalogs: DataFrame, schema_table: DataFrame
) -> DataFrame:
    """Listed schemas with their own id and their catalog's."""
    with_schema = listed_schemas.join(schema_entities(schema_table), _SCHEMA_KEY, "left")
    return skew_safe_join(with_schema, catalog_entities(catalogs), ["catalog_name"], "left")


def look_up_tables(
    listed_tables: DataFrame,
    listed_schemas: DataFrame,
    catalogs: DataFrame,
    schema_table: DataFrame,
    table_table: DataFrame,
) -> DataFrame:
    """Listed tables of listed schemas with everything the entity tables know of them.

    Listing and table entities are both reduced to one row per table and joined on the key
    they are grouped by, so their join adds no shuffle. The second join meets hot schemas:
    Spark broadcasts the schema side if it is small and splits hot partitions otherwise.
    """
    schema_facts = look_up_schemas(listed_schemas, catalogs, schema_table)
    with_table = listed_tables.join(table_entities(table_table), _TABLE_KEY, "left")
    return skew_safe_join(with_table, schema_facts, _SCHEMA_KEY, "inner")


def _reason():
    return (
        F.when(F.col("catalog_conflict"), "catalog entities disagree")
        .when(F.col("schema_conflict"), "schema entities disagree")
        .when(F.col("table_conflict"), "table entities disagree")
        .when(F.col("catalog_id").isNull(), "catalog has no id")
        .when(F.col("schema_id").isNull(), "schema has no id")
        .when(F.col("table_id").isNull(), "table has no id")
        .when(F.col("storage_location").isNull(), "table has no location")
        .when(F.col("table_type").isNull(), "table has no type")
    )


def inventory(facts: DataFrame) -> DataFrame:
    """Inventory rows of looked-up tables; incomplete ones are left to ``rejects``."""
    return facts.filter(_reason().isNull()).select(
        F.col("catalog_id").alias(fv.CATALOG_ID),
        F.col("schema_id").alias(fv.SCHEMA_ID),
        F.col("table_id").alias(fv.TABLE_ID),
        F.col("catalog_name").alias(fv.CATALOG_NAME),
        F.col("schema_name").alias(fv.SCHEMA_NAME),
        F.col("table_name").alias(fv.TABLE_NAME),
        F.col("storage_location").alias(fv.TABLE_LOCATION),
        F.col("table_type").alias(fv.TABLE_TYPE),
    )


def rejects(facts: DataFrame) -> DataFrame:
    """Looked-up tables that cannot be keyed or described, with the reason."""
    return facts.select(*_TABLE_KEY, _reason().alias("reason")).filter(F.col("reason").isNotNull())


def schemas_of(schema_facts: DataFrame) -> DataFrame:
    """Looked-up schemas under inventory column names; incomplete ones left out."""
    return schema_facts.filter(
        F.col("catalog_id").isNotNull()
        & F.col("schema_id").isNotNull()
        & ~F.col("catalog_conflict")
        & ~F.col("schema_conflict")
    ).select(
        F.col("catalog_id").alias(fv.CATALOG_ID),
        F.col("catalog_name").alias(fv.CATALOG_NAME),
        F.col("schema_id").alias(fv.SCHEMA_ID),
        F.col("schema_name").alias(fv.SCHEMA_NAME),
    )


def tables_per_schema(schema_rows: DataFrame, inventory_rows: DataFrame) -> DataFrame:
    """Table count of every schema, 0 for empty ones.

    Tables are counted before the join, so a hot schema joins as one row.
    """
    key = schema_rows.columns
    counts = inventory_rows.groupBy(*key).agg(F.count("*").alias("n_tables"))
    return schema_rows.join(counts, key, "left").fillna(0, "n_tables")


