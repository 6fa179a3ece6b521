"""Copies in buckets: the same rows as from plain tables, without exchanging them."""

import re

import pytest
from pyspark.sql import functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.operators.keys import keyed
from metaloom.operators.merge import upsert_metadata
from metaloom.operators.view import enriched_view
from metaloom.plans.colocated import colocate, upsert_into, view_of
from metaloom.session import stage, staging_path
from metaloom.sources.tables import typed_rows
from tests.fixtures import bag

KEYS = {"metadata": schemas.SOURCE_NAMES, "tags": schemas.TAG_KEYS}


def rows(spark, n, hot):
    """Metadata of ``n`` tables, the first ``hot`` under one name, and their tags, of which one table has very many."""
    ids = spark.range(n).withColumn("hot", F.col("id") < hot)
    name = F.when(F.col("hot"), "hot").otherwise(F.concat(F.lit("t"), F.col("id")))
    metadata = ids.select(
        F.lit("c").alias(fv.CATALOG_ID),
        F.lit("s").alias(fv.SCHEMA_ID),
        F.col("id").cast("string").alias(fv.TABLE_ID),
        F.lit("cat").alias(fv.CATALOG_NAME),
        F.when(F.col("id") % 7 > 0, F.lit("s")).alias(fv.SCHEMA_NAME),  # some have no name
        name.alias(fv.TABLE_NAME),
        F.lit("s3://x").alias(fv.TABLE_LOCATION),
        F.lit("MANAGED").alias(fv.TABLE_TYPE),
    )
    tags = ids.filter("id % 3 = 0 OR hot").select(
        F.lit("cat").alias("catalog_name"),
        F.lit("s").alias("schema_name"),
        name.alias("table_name"),
        F.when(F.col("id") % 2 == 0, fv.TARGET_TABLE).otherwise(fv.SYNC_FLAG).alias("tag_name"),
        F.col("id").cast("string").alias("tag_value"),
    )
    return stage(keyed(metadata), "metadata"), stage(tags, "tags")


def copies(spark, metadata, tags, **settings):
    spark.sql("CREATE SCHEMA IF NOT EXISTS buckets")
    tables = {"metadata": (metadata, KEYS["metadata"]), "tags": (tags, KEYS["tags"])}
    return colocate(spark, "spark_catalog", "buckets", staging_path(spark, "buckets"), tables, **settings)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (\w+)", plan)


@pytest.fixture
def no_broadcast(conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})


def test_the_view_exchanges_nothing(spark, no_broadcast):
    metadata, tags = rows(spark, 3000, 0)
    made = copies(spark, metadata, tags)
    assert made["metadata"].hot is None and made["metadata"].number == 3
    view = view_of(made["metadata"], made["tags"])
    assert exchanges(enriched_view(metadata, tags)) and not exchanges(view)
    assert bag(view) == bag(enriched_view(metadata, tags))


@pytest.mark.parametrize("buckets", [3, 16])
def test_hot_names_are_kept_apart(spark, no_broadcast, buckets):
    metadata, tags = rows(spark, 3000, 1000)
    made = copies(spark, metadata, tags, hot_rows=200, buckets=buckets)
    hot = made["metadata"].hot.groupBy(*schemas.SOURCE_NAMES).count().collect()
    assert {r[fv.TABLE_NAME] for r in hot} == {"hot"} and made["tags"].hot.count() == 1000
    left = made["metadata"].cold.groupBy(*schemas.SOURCE_NAMES).count().agg(F.max("count")).first()[0]
    assert left <= max(200, 3000 / buckets)
    assert bag(view_of(made["metadata"], made["tags"])) == bag(enriched_view(metadata, tags))


def test_a_merge_exchanges_the_batch_alone(spark, no_broadcast):
    metadata, _ = rows(spark, 2000, 0)
    other, _ = rows(spark, 3000, 100)
    batch = other.filter("CAST(" + fv.TABLE_ID + " AS INT) >= 1000")
    spark.sql("CREATE SCHEMA IF NOT EXISTS buckets")
    tables = {"by_id": (metadata, [fv.RECORD_ID])}
    made = colocate(spark, "spark_catalog", "buckets", staging_path(spark, "buckets"), tables, buckets=5)["by_id"]
    merged = upsert_into(made, batch)
    assert len(exchanges(merged)) == 1
    assert bag(merged) == bag(upsert_metadata(metadata, batch))


def test_merges_need_buckets_of_the_id(spark):
    made = copies(spark, *rows(spark, 10, 0))
    with pytest.raises(ValueError, match="buckets of unique"):
        upsert_into(made["metadata"], typed_rows(spark, [], schemas.METADATA))


def test_empty_tables(spark):
    made = copies(spark, typed_rows(spark, [], schemas.METADATA), typed_rows(spark, [], schemas.TAGS))
    view = view_of(made["metadata"], made["tags"])
    assert view.columns == schemas.VIEW.names and view.count() == 0


def test_a_dropped_copy_leaves_its_files(spark):
    made = copies(spark, *rows(spark, 10, 0))["metadata"]
    rest = made.cold
    folder = made.drop()
    assert not spark.catalog.tableExists(made.name) and rest.count() == 10
    assert spark.read.parquet(f"{folder}/cold").count() == 10
