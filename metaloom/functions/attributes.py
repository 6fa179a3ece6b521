"""Expressions over single attributes: ids in locations, flags and links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from metaloom import fixed_values as fv
from metaloom.functions.text import fill


def uuid_in(location: Column) -> Column:
    """First UUID-like match in a storage location, NULL without one."""
    return F.nullif(F.regexp_extract(location, fv.UUID_PATTERN, 1), F.lit(""))


def is_true(flag: Column) -> Column:
    """A text flag as a boolean that is never NULL: text that is no boolean counts as false."""
    return F.coalesce(flag.try_cast("boolean"), F.lit(False))


def link() -> Column:
    """Deep link to a mirrored table; NULL until a sync succeeded or if a part is missing."""
    account = F.split(F.col(fv.ACCOUNT), "-")
    url = fill(
        fv.LINK_TEXT,
        account_0=F.lower(F.get(account, F.lit(0))),
        account_1=F.lower(F.get(account, F.lit(1))),
        database=F.upper(F.col(fv.TARGET_DATABASE)),
        schema=F.upper(F.col(fv.TARGET_SCHEMA)),
        table=F.upper(F.col(fv.TARGET_TABLE)),
    )
    return F.when(F.col(fv.SYNC_STATUS) == fv.STATUS_SUCCESS, url)
