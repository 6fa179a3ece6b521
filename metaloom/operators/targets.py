"""What is ready to be mirrored: integrations, tables, databases and schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from metaloom import fixed_values as fv
from metaloom.functions.attributes import is_true

_INTEGRATION = (fv.INTEGRATION, fv.CATALOG_NAME, fv.SCHEMA_NAME)
_TARGET = (fv.TARGET_DATABASE, fv.TARGET_SCHEMA, fv.TARGET_TABLE)
_TABLE = (fv.RECORD_ID, fv.INTEGRATION, fv.TABLE_NAME, *_TARGET, fv.EXTERNAL_VOLUME)


def _all_present(*names: str):
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def integration_targets(view: DataFrame) -> DataFrame:
    """Distinct integrations with the catalog and schema they serve, whatever the sync flag.

    Uses metadata columns only, so Spark drops the tag side of the view from the plan.
    """
    return view.filter(_all_present(*_INTEGRATION)).select(*_INTEGRATION).distinct()


def eligible_tables(view: DataFrame, unique_records: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Distinct tables with a true sync flag, an integration and a complete target name.

    ``keep`` names more columns of the view to carry along, such as those its table is dealt by.

    ``unique_records`` says that record ids do not repeat, as a merged metadata table
    guarantees. Rows are distinct then as they are, and the shuffle is saved.
    """
    ready = is_true(F.col(fv.SYNC_FLAG)) & _all_present(fv.INTEGRATION, fv.TABLE_NAME, *_TARGET)
    tables = view.filter(ready).select(*_TABLE, *keep)
    return tables if unique_records else tables.distinct()


def target_databases(tables: DataFrame) -> DataFrame:
    """Distinct databases that eligible tables go to."""
    return tables.select(fv.TARGET_DATABASE).distinct()


def target_schemas(tables: DataFrame) -> DataFrame:
    """Distinct schemas, with their database, that eligible tables go to."""
    return tables.select(fv.TARGET_DATABASE, fv.TARGET_SCHEMA).distinct()
