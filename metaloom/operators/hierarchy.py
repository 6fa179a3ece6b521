"""Nested catalogs: catalog > schemas > tables, and back.

A catalog is one or more rows ("pages"), and a schema with many tables is one or more nodes
spread over them: a catalog holding a third of all tables must not become a single row.
Flattening the pages gives every table once, however they were cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from metaloom import fixed_values as fv
from metaloom.operators.joins import skew_safe_join
from metaloom.operators.paging import PAGE_SIZE, page_count, page_of

_CATALOG = [fv.CATALOG_ID, fv.CATALOG_NAME]
_SCHEMA = [*_CATALOG, fv.SCHEMA_ID, fv.SCHEMA_NAME]


def _node(uc_id: str, uc_name: str, *rest: Column) -> Column:
    return F.struct(
        F.col(uc_id).alias("uc_id"),
        F.col(uc_name).alias("uc_name"),
        F.col(uc_name).alias("sf_name"),
        *rest,
    )


def nest(
    inventory: DataFrame,
    schemas: DataFrame | None = None,
    include_empty_schemas: bool = True,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Inventory rows as catalog rows: ``uc_id, uc_name, sf_name, page, schemas``.

    ``schemas`` names all schemas; those without inventory rows appear with an empty table
    list unless ``include_empty_schemas`` is off. Keys must be complete, as ``inventory``
    leaves them.

    The tables are shuffled twice, by schema to learn its page count and by page to be
    gathered. Page counts come from one row per schema, computed once: the explicit NULL
    check makes its two uses the same plan, which Spark then reuses.
    """
    tables = inventory.select(
        *_SCHEMA,
        F.col(fv.TABLE_ID).alias("table_key"),
        _node(
            fv.TABLE_ID,
            fv.TABLE_NAME,
            F.col(fv.TABLE_LOCATION).alias("location"),
            F.col(fv.TABLE_TYPE).alias("table_type"),
        ).alias("table"),
    )
    if schemas is not None and include_empty_schemas:
        tables = tables.unionByName(schemas.select(*_SCHEMA), allowMissingColumns=True)
    tables = tables.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in _SCHEMA]))

    sizes = tables.groupBy(*_SCHEMA).agg(F.count("table_key").alias("n_tables"))
    weight = F.sum(F.greatest(F.col("n_tables"), F.lit(1)))
    catalog_pages = sizes.groupBy(*_CATALOG).agg(page_count(weight, page_size).alias("catalog_pages"))
    sizes = skew_safe_join(sizes, catalog_pages, _CATALOG, "inner").withColumn(
        "schema_pages", page_count(F.col("n_tables"), page_size)
    )
    return (
        skew_safe_join(tables, sizes, _SCHEMA, "inner")
        .withColumn("schema_page", page_of(F.col("schema_pages"), F.col("table_key")))
        .groupBy(*_SCHEMA, "n_tables", "catalog_pages", "schema_page")
        .agg(F.collect_list("table").alias("tables"))
        .filter((F.size("tables") > 0) | (F.col("n_tables") == 0))
        .select(
            *_CATALOG,
            page_of(F.col("catalog_pages"), F.col(fv.SCHEMA_ID), F.col("schema_page")).alias("page"),
            _node(fv.SCHEMA_ID, fv.SCHEMA_NAME, F.col("tables")).alias("schema"),
        )
        .groupBy(*_CATALOG, "page")
        .agg(F.collect_list("schema").alias("schemas"))
        .select(
            F.col(fv.CATALOG_ID).alias("uc_id"),
            F.col(fv.CATALOG_NAME).alias("uc_name"),
            F.col(fv.CATALOG_NAME).alias("sf_name"),
            "page",
            "schemas",
        )
    )


def flatten(catalogs: DataFrame) -> DataFrame:
    """Catalog rows as inventory rows; schemas without tables vanish."""
    return (
        catalogs.select("uc_id", "uc_name", F.explode("schemas").alias("s"))
        .select("uc_id", "uc_name", "s.uc_id", "s.uc_name", F.explode("s.tables").alias("t"))
        .toDF(fv.CATALOG_ID, fv.CATALOG_NAME, fv.SCHEMA_ID, fv.SCHEMA_NAME, "t")
        .select(
            fv.CATALOG_ID,
            fv.SCHEMA_ID,
            F.col("t.uc_id").alias(fv.TABLE_ID),
            fv.CATALOG_NAME,
            fv.SCHEMA_NAME,
            F.col("t.uc_name").alias(fv.TABLE_NAME),
            F.col("t.location").alias(fv.TABLE_LOCATION),
            F.col("t.table_type").alias(fv.TABLE_TYPE),
        )
    )
