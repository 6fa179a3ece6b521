"""Typed frames from rows, and stored tables by name or path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from metaloom import schemas


def typed_rows(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    """Rows as a DataFrame of a declared schema, also when empty or all NULL."""
    return spark.createDataFrame(list(rows), schema)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types; absent ones are typed NULLs."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table, or Parquet files when ``source`` is a path."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_tags(spark: SparkSession, source: str) -> DataFrame:
    """The long tag table."""
    return read_table(spark, source).select(*schemas.TAGS.names)


def read_metadata(spark: SparkSession, source: str) -> DataFrame:
    """The metadata table."""
    return read_table(spark, source).select(*schemas.METADATA.names)


def empty_metadata(spark: SparkSession) -> DataFrame:
    """A metadata table without rows."""
    return typed_rows(spark, [], schemas.METADATA)
