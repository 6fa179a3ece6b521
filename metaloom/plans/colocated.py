"""Copies of stored tables in buckets of a key that they share, so that joins on the key move none of their rows.

A join or grouping by the key reads bucket by bucket and needs no exchange. A bucket cannot be
split at run time, so rows of hot keys are kept apart, in plain files: what is computed on them
is exchanged and split as ever, and the results of both are put together.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from metaloom import fixed_values as fv
from metaloom.functions.text import quoted
from metaloom.operators.merge import upsert_metadata
from metaloom.operators.view import enriched_view

#: Rows of a bucket, about. A key with fewer than ``HOT_ROWS`` rows is never hot.
BUCKET_ROWS, HOT_ROWS = 500_000, 10_000


@dataclass(frozen=True)
class Buckets:
    """The copy of one table: a bucketed catalog table, and files of the rows with hot keys, if there are any."""

    spark: SparkSession
    name: str
    folder: str
    number: int
    keys: tuple[str, ...]
    hot: DataFrame | None

    @property
    def cold(self) -> DataFrame:
        """The rows of all keys that are not hot, partitioned by the key."""
        return self.spark.table(self.name)

    def drop(self) -> str:
        """Take the copy out of the catalog; its folder, which may still be read, is left for deletion."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return self.folder


def colocate(
    spark: SparkSession,
    catalog: str,
    schema: str,
    location: str,
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
    buckets: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> dict[str, Buckets]:
    """Copy tables, each given with its key columns, into as many buckets of equal keys each.

    Key columns correspond by place and have the same types in all tables. A key is hot if in some
    table it has more rows than an average bucket, and ``hot_rows`` at least: there are fewer of
    them than buckets and tables, and they are hot in all tables alike. Without ``buckets`` there
    is one for each ``BUCKET_ROWS`` rows of the largest table, and as many as a shuffle has
    partitions at least, as Spark prefers exchanges to fewer tasks. Rows whose keys are NULL are
    rows of a key as well. Tables are read twice: pass stored ones. Empty tables have empty copies.
    """
    counted = {
        name: rows.groupBy(F.xxhash64(*keys).alias("key")).agg(F.count("*").alias("n"))
        for name, (rows, keys) in tables.items()
    }
    sizes = {name: rows.count() for name, (rows, _) in tables.items()}
    if buckets is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, math.ceil(max(sizes.values()) / BUCKET_ROWS))
    above = {name: max(hot_rows, size / buckets) for name, size in sizes.items()}
    crowded = [n.filter(F.col("n") > above[name]).select("key") for name, n in counted.items() if sizes[name] > hot_rows]
    hot = [r.key for r in reduce(DataFrame.unionByName, crowded).distinct().collect()] if crowded else []
    copies = {}
    for name, (rows, keys) in tables.items():
        run = f"{name}_{uuid.uuid4().hex}"
        folder, full = f"{location}/{run}", quoted(catalog, schema, run)
        is_hot = F.xxhash64(*keys).isin(hot)
        cold = rows.filter(~is_hot) if hot else rows
        writer = cold.repartition(buckets, *keys).write.format("parquet").option("path", f"{folder}/cold")
        writer.bucketBy(buckets, *keys).saveAsTable(full)
        if hot:
            rows.filter(is_hot).write.parquet(f"{folder}/hot")
        apart = spark.read.schema(rows.schema).parquet(f"{folder}/hot") if hot else None
        copies[name] = Buckets(spark, full, folder, buckets, tuple(keys), apart)
    return copies


def view_of(metadata: Buckets, tags: Buckets) -> DataFrame:
    """The enriched view of copies in buckets of the table names: neither is exchanged, but for hot names."""
    view = enriched_view(metadata.cold, tags.cold, colocated=True)
    return view if metadata.hot is None else view.unionByName(enriched_view(metadata.hot, tags.hot))


def upsert_into(metadata: Buckets, batch: DataFrame) -> DataFrame:
    """The metadata table after a refresh, of a copy in buckets of the record id: only the batch is exchanged, once.

    Record ids are unique, so none is hot; a copy with repeated ids is refused.
    """
    if metadata.keys != (fv.RECORD_ID,) or metadata.hot is not None:
        raise ValueError(f"a copy in buckets of unique {fv.RECORD_ID} is needed")
    return upsert_metadata(metadata.cold, batch.repartition(metadata.number, fv.RECORD_ID))
