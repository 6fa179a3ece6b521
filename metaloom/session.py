"""Session helpers: a local session for tests and bench, and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_root: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-process session; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("metaloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may do without the setting; it gets a fresh folder once.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_root


def warehouse_root(spark: SparkSession) -> str:
    """Where tables go by default: ``spark.sql.warehouse.dir``, which on a cluster must not be a local folder."""
    root = spark.conf.get("spark.sql.warehouse.dir")
    local = root.startswith("file:") or "://" not in root
    if local and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("name a location for tables, or set spark.sql.warehouse.dir, that every executor can reach")
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A path below the staging root that no other run uses."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage: a lost executor costs a re-read, not a recomputation, and rows that
    came from a side effect are produced once.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
