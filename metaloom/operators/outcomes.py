"""Outcome rows classified."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from metaloom import fixed_values as fv
from metaloom.functions import outcomes as classify


def table_outcomes(
    outcomes: DataFrame,
    account: Column | str,
    synced_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Outcome rows of table statements as status rows.

    ``account`` is the account they ran in, as text or a column. ``synced_at`` replaces the
    time of each outcome, for instance by ``current_timestamp()``. ``keep`` names columns to
    carry along, for instance to order a log by.
    """
    error = F.col("error")
    account = F.lit(account) if isinstance(account, str) else account
    when = F.col("applied_at") if synced_at is None else synced_at
    return outcomes.select(
        fv.RECORD_ID,
        account.alias(fv.ACCOUNT),
        classify.table_status(error).alias(fv.SYNC_STATUS),
        classify.table_message(F.col("object_name"), error, F.col("error_kind")).alias(fv.SYNC_MESSAGE),
        when.cast("timestamp").alias(fv.SYNC_DATE),
        *keep,
    )


def integration_outcomes(outcomes: DataFrame) -> DataFrame:
    """Outcome rows of integration statements with a ``result``."""
    return outcomes.withColumn(
        "result", classify.integration_result(F.col("error"), F.col("error_kind"))
    )


def container_outcomes(outcomes: DataFrame) -> DataFrame:
    """Outcome rows of database and schema statements with a ``result``."""
    return outcomes.withColumn(
        "result", classify.container_result(F.col("error"), F.col("error_kind"))
    )
