"""Classifying what came of running a statement.

``error`` is NULL when the statement worked; ``error_kind`` is ``compile``, ``conflict``
or ``other``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from metaloom import fixed_values as fv
from metaloom.functions.text import fill

CREATED = "created"
SKIPPED = "skipped"
EXISTS = "already exists"
ERROR = "error"


def table_status(error: Column) -> Column:
    return F.when(error.isNull(), fv.STATUS_SUCCESS).otherwise(fv.STATUS_FAILED)


def table_message(object_name: Column, error: Column, error_kind: Column) -> Column:
    """Success text, or the error text behind the prefix of its kind."""
    prefix = F.when(error_kind == "compile", fv.COMPILE_ERROR_PREFIX).otherwise(fv.OTHER_ERROR_PREFIX)
    return F.when(error.isNull(), fill(fv.SUCCESS_MESSAGE, table=object_name)).otherwise(
        F.concat(prefix, error)
    )


def integration_result(error: Column, error_kind: Column) -> Column:
    """Only the warehouse's own refusals, never an ``other`` error, say that it exists."""
    refused = F.coalesce(error_kind != "other", F.lit(True))
    return (
        F.when(error.isNull(), CREATED)
        .when(refused & error.contains(fv.ALREADY_EXISTS), SKIPPED)
        .otherwise(ERROR)
    )


def container_result(error: Column, error_kind: Column) -> Column:
    """Result of creating a database or schema."""
    return F.when(error.isNull(), CREATED).when(error_kind == "conflict", EXISTS).otherwise(ERROR)
