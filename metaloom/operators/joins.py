"""Equi-joins that stay splittable when a key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def unused_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no frame has such a column, whatever its case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def skew_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left.join(right, keys, how)`` whose hot keys Spark can split at run time.

    Adaptive execution splits a skewed partition only if both join inputs come straight out
    of exchanges made for the join. An input that a grouping already partitioned by the join
    key would skip its exchange and leave a hot key in one task. Joining on the key and a
    hash of it asks for fresh exchanges on both sides; rows match exactly as before. Sides
    below the broadcast threshold are broadcast as usual and not exchanged at all.
    """
    name = unused_name("_key_hash", left, right)
    key_hash = F.xxhash64(*(F.col(k) for k in keys))
    joined = left.withColumn(name, key_hash).join(right.withColumn(name, key_hash), [name, *keys], how)
    return joined.drop(name)
