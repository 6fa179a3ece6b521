"""Merges into the metadata table. Each returns the whole table as it is afterwards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.sources.tables import conform

_ID = fv.RECORD_ID


def _fail_if(condition: Column, *message: Column | str) -> Column:
    """A filter that keeps every row and fails the job on one that meets ``condition``."""
    text = F.concat(*(F.lit(m) if isinstance(m, str) else m for m in message))
    return F.when(condition, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))


def _unique(rows: DataFrame, what: str) -> DataFrame:
    """Rows, checked to have one per record id and none without.

    Rows are counted per id with map-side combining, so not even a batch of mostly copies
    gathers them. The result is partitioned by id, as a merge join needs it.
    """
    others = [c for c in rows.columns if c != _ID]
    return (
        rows.groupBy(_ID)
        .agg(F.count("*").alias("n"), F.min(F.struct(*others)).alias("row"))
        .filter(_fail_if(F.col(_ID).isNull(), f"{what} has a row without a record id"))
        .filter(_fail_if(F.col("n") > 1, f"{what} repeats record id ", F.col(_ID).cast("string")))
        .select(_ID, "row.*")
    )


def unique_batch(batch: DataFrame) -> DataFrame:
    """A refresh batch in metadata columns; fails on a repeated or missing record id."""
    return _unique(conform(batch, schemas.METADATA), "batch")


def _same_source() -> Column:
    return (
        F.col(f"t.{fv.CATALOG_ID}").eqNullSafe(F.col(f"u.{fv.CATALOG_ID}"))
        & F.col(f"t.{fv.SCHEMA_ID}").eqNullSafe(F.col(f"u.{fv.SCHEMA_ID}"))
        & F.col(f"t.{fv.TABLE_ID}").eqNullSafe(F.col(f"u.{fv.TABLE_ID}"))
    )


def _merged(joined: DataFrame) -> DataFrame:
    """Rows of ``t`` and ``u`` joined on id as merged rows."""
    old, new = F.col(f"t.{_ID}").isNotNull(), F.col(f"u.{_ID}").isNotNull()
    columns = [F.coalesce(F.col(f"t.{_ID}"), F.col(f"u.{_ID}")).alias(_ID)]
    for name in schemas.METADATA.names:
        if name == _ID:
            continue
        first = F.when(new, F.col(f"u.{name}")).otherwise(F.col(f"t.{name}"))
        kept = F.when(old, F.col(f"t.{name}")).otherwise(F.col(f"u.{name}"))
        columns.append((first if name in schemas.REFRESHED else kept).alias(name))
    collision = _fail_if(
        old & new & ~_same_source(), "different tables share record id ", F.col(f"t.{_ID}").cast("string")
    )
    return joined.filter(collision).select(*columns)


def upsert_metadata(metadata: DataFrame, batch: DataFrame) -> DataFrame:
    """The metadata table after a refresh.

    Known records take names, location, type and integration from the batch and keep ids and
    sync columns. Unknown ones are added whole. None is ever removed. A batch that repeats an
    id is refused, and so is a hash collision.

    One full outer join on the id. Ids are hashes and unique on both sides, so it does not skew.
    """
    t, u = metadata.alias("t"), unique_batch(batch).alias("u")
    return _merged(t.join(u, F.col(f"t.{_ID}") == F.col(f"u.{_ID}"), "full"))


def changed_rows(metadata: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of a refresh batch that an upsert would add or change.

    The whole batch is checked first, as ``upsert_metadata`` does. A row whose id is known with other source ids is a
    hash collision; it stays, and the upsert refuses it. Only the compared columns of the metadata are read. They are
    compared as a count of differences, which is no join key: rows join by id, by which the batch is already dealt.
    """
    compared = (*schemas.SOURCE_IDS, *schemas.REFRESHED)
    known = metadata.select(_ID, *compared).alias("t")
    differ = (F.when(F.col(f"t.{c}").eqNullSafe(F.col(f"u.{c}")), 0).otherwise(1) for c in compared)
    same = (F.col(f"t.{_ID}") == F.col(f"u.{_ID}")) & (reduce(Column.__add__, differ) == 0)
    return unique_batch(batch).alias("u").join(known, same, "left_anti").select(*schemas.METADATA.names)


def upsert_small_batch(metadata: DataFrame, batch: DataFrame) -> DataFrame:
    """Same result as ``upsert_metadata``, in a form for small batches.

    A full outer join cannot broadcast. Here the batch sits on the inner side of a left join
    and a semi join instead, which Spark runs without shuffling the metadata if the batch is
    below its broadcast threshold. Above it the result is still right, at three joins.
    """
    batch = unique_batch(batch)
    t, u = metadata.alias("t"), batch.alias("u")
    updated = _merged(t.join(u, F.col(f"t.{_ID}") == F.col(f"u.{_ID}"), "left"))
    known = metadata.select(_ID).join(batch.select(_ID), _ID, "left_semi")
    added = batch.join(known, _ID, "left_anti").select(*schemas.METADATA.names)
    return updated.unionByName(added)


def latest_status(log: DataFrame, order_by: Sequence[str] = (fv.SYNC_DATE,)) -> DataFrame:
    """The newest status row of each record, as if the log's batches had been merged in turn.

    Rows that tie on ``order_by`` are decided by their values. A maximum of structs combines
    map-side, so a record with very many log rows is no hot group.
    """
    status = [c for c in schemas.STATUS.names if c != _ID]
    order = F.struct(*(F.col(c) for c in order_by))
    return (
        log.groupBy(_ID)
        .agg(F.max(F.struct(order.alias("at"), F.struct(*status).alias("status"))).alias("newest"))
        .select(_ID, "newest.status.*")
    )


def _with_status(metadata: DataFrame, status: DataFrame) -> DataFrame:
    t, u = metadata.alias("t"), status.alias("u")
    joined = t.join(u, F.col(f"t.{_ID}") == F.col(f"u.{_ID}"), "left")
    hit = F.col(f"u.{_ID}").isNotNull()
    return joined.select(
        *(
            F.when(hit, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            if c in schemas.SYNC
            else F.col(f"t.{c}")
            for c in schemas.METADATA.names
        )
    )


def update_status(metadata: DataFrame, status: DataFrame) -> DataFrame:
    """The metadata table with the sync columns of a status batch.

    Status rows of unknown records are dropped; a batch that repeats an id is refused. The
    status side is broadcast if Spark finds it small, and the metadata stays where it is then.
    """
    return _with_status(metadata, _unique(conform(status, schemas.STATUS), "status batch"))


def apply_status(
    metadata: DataFrame, log: DataFrame, order_by: Sequence[str] = (fv.SYNC_DATE,)
) -> DataFrame:
    """The metadata table with the newest row of a status log for each record.

    The fold leaves the log partitioned by id, which is how the join needs it.
    """
    return _with_status(metadata, latest_status(log, order_by))
