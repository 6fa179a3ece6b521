"""Lists of bounded size.

One list per group would gather a hot group into one row. These operators spread each group
over as many pages as its row count asks for: pages are picked by hash, so no task sorts or
numbers a whole group, and a page holds about ``page_size`` rows however large the group.
Rows of a group must be distinct, as listings and targets are: copies share a page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.operators.joins import skew_safe_join

PAGE_SIZE = 1000


def page_count(rows: Column, page_size: int) -> Column:
    """Pages needed for ``rows`` rows, at least one."""
    return F.greatest(F.ceil(rows / F.lit(page_size)), F.lit(1)).cast("long")


def page_of(pages: Column, *key: Column) -> Column:
    """The page of the row with this key."""
    return F.pmod(F.xxhash64(*key), pages)


def paged_lists(
    rows: DataFrame,
    group: Sequence[str],
    columns: Sequence[str],
    alias: str,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """``columns`` of each group's rows as lists of structs: ``*group, page, <alias>``.

    Counts are combined map-side and joined back; a hot group's rows are then split by page
    before they are gathered.
    """
    sizes = rows.groupBy(*group).agg(page_count(F.count("*"), page_size).alias("pages"))
    return (
        skew_safe_join(rows, sizes, group, "inner")
        .withColumn("page", page_of(F.col("pages"), *(F.col(c) for c in columns)))
        .groupBy(*group, "page")
        .agg(F.collect_list(F.struct(*columns)).alias(alias))
    )


def list_pages(rows: DataFrame, alias: str = "combinations", page_size: int = PAGE_SIZE) -> DataFrame:
    """All rows as lists of structs, a page per row: ``page, <alias>``; no rows, no pages."""
    pages = rows.select(page_count(F.count("*"), page_size).alias("pages")).scalar()
    return (
        rows.withColumn("page", page_of(pages, *(F.col(c) for c in rows.columns)))
        .groupBy("page")
        .agg(F.collect_list(F.struct(*rows.columns)).alias(alias))
    )
