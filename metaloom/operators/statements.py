"""Statement rows: what to run, and for which object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from metaloom import fixed_values as fv
from metaloom.functions import statements as text
from metaloom.functions.text import dotted_name, is_blank


def not_blank(statements: DataFrame) -> DataFrame:
    """Statement rows without those whose ``statement`` is NULL, empty or white space: a warehouse refuses them."""
    return statements.filter(~is_blank(F.col("statement")))


def table_statements(
    tables: DataFrame, auto_refresh: bool = True, quote_identifiers: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """``<record id>, object_name, statement`` for eligible tables, and the columns to ``keep``."""
    return not_blank(
        tables.select(
            fv.RECORD_ID,
            F.col(fv.TARGET_TABLE).alias("object_name"),
            text.table_statement(F.lit(auto_refresh), quote_identifiers).alias("statement"),
            *keep,
        )
    )


def integration_statements(
    targets: DataFrame,
    endpoint: str,
    oauth_client_id: str,
    refresh_interval_seconds: int = fv.REFRESH_INTERVAL_SECONDS,
    access_delegation_mode: str = fv.ACCESS_DELEGATION_MODE,
    quote_identifiers: bool = False,
) -> DataFrame:
    """``object_name, statement`` for integration targets. The secret stays a placeholder."""
    return not_blank(
        targets.select(
            F.col(fv.INTEGRATION).alias("object_name"),
            text.integration_statement(
                F.lit(endpoint),
                F.lit(oauth_client_id),
                F.lit(refresh_interval_seconds),
                F.lit(access_delegation_mode),
                quote_identifiers,
            ).alias("statement"),
        )
    )


def database_statements(databases: DataFrame, quote_identifiers: bool = False) -> DataFrame:
    """``object_name, statement`` for target databases."""
    return not_blank(
        databases.select(
            F.col(fv.TARGET_DATABASE).alias("object_name"),
            text.database_statement(quote_identifiers).alias("statement"),
        )
    )


def schema_statements(schemas: DataFrame, quote_identifiers: bool = False) -> DataFrame:
    """``object_name, statement`` for target schemas."""
    return not_blank(
        schemas.select(
            dotted_name(F.col(fv.TARGET_DATABASE), F.col(fv.TARGET_SCHEMA)).alias("object_name"),
            text.schema_statement(quote_identifiers).alias("statement"),
        )
    )
