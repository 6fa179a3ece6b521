"""Plans that have to hold at scale: pruning, pushdown, shuffles and skew."""

import re

import pytest
from pyspark.sql import functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.operators import targets
from metaloom.operators.hierarchy import nest
from metaloom.operators.inventory import look_up_tables
from metaloom.operators.keys import keyed
from metaloom.operators.merge import apply_status, upsert_metadata, upsert_small_batch
from metaloom.operators.tags import set_default_tags
from metaloom.operators.view import enriched_view
from metaloom.session import stage
from metaloom.sources import listings
from metaloom.sources.tables import typed_rows
from tests.fixtures import bag


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    """The plan after running it."""
    df.collect()
    return executed(df).split("== Initial Plan ==")[0]


def shuffles(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.fixture(scope="module")
def stored(spark):
    """Inputs as files, with a third of all metadata rows sharing one table name."""
    ids = spark.range(30_000).withColumn("hot", F.col("id") < 10_000)
    rows = ids.select(
        F.lit("c").alias(fv.CATALOG_ID),
        F.when(F.col("hot"), "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias(fv.SCHEMA_ID),
        F.col("id").cast("string").alias(fv.TABLE_ID),
        F.lit("cat").alias(fv.CATALOG_NAME),
        F.when(F.col("hot"), "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias(fv.SCHEMA_NAME),
        F.when(F.col("hot"), "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias(fv.TABLE_NAME),
        F.sha2(F.col("id").cast("string"), 512).alias(fv.TABLE_LOCATION),
        F.lit("MANAGED").alias(fv.TABLE_TYPE),
    )
    metadata = stage(keyed(rows).repartition(8), "metadata")
    tag_rows = metadata.select(
        *(F.col(n).alias(k) for n, k in zip(schemas.SOURCE_NAMES, schemas.TAG_KEYS)),
        F.explode(F.array(*(F.lit(n) for n in schemas.TAG_NAMES))).alias("tag_name"),
        F.lit("true").alias("tag_value"),
    )
    return {
        "inventory": stage(rows.repartition(8), "inventory"),
        "metadata": metadata,
        "tags": stage(tag_rows, "tags"),
    }


@pytest.fixture
def no_broadcast(conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})


@pytest.fixture
def skew(conf, no_broadcast):
    """Thresholds brought down to the size of the fixture."""
    conf(
        **{
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        }
    )


class TestPruning:
    def test_integrations_do_not_read_tags(self, stored):
        view = enriched_view(stored["metadata"], stored["tags"])
        plan = executed(targets.integration_targets(view))
        assert "Join" not in plan and plan.count("FileScan") == 1 and "tag_value" not in plan

    def test_eligible_tables_use_an_inner_join_and_few_columns(self, stored, no_broadcast):
        view = enriched_view(stored["metadata"], stored["tags"])
        plan = executed(targets.eligible_tables(view, unique_records=True))
        assert "Inner" in plan and "LeftOuter" not in plan and fv.TABLE_LOCATION not in plan

    def test_discovery_tags_are_filtered_at_the_scan(self, stored):
        plan = executed(enriched_view(stored["metadata"], stored["tags"]))
        assert re.search(r"PushedFilters: \[In\(tag_name", plan)

    def test_each_page_is_parsed_once(self, spark):
        pages = typed_rows(spark, [("c", "s", "{}")], schemas.TABLE_PAGES)
        assert executed(listings.list_tables(pages)).count("from_json") == 1
        pages = typed_rows(spark, [("c", "{}")], schemas.SCHEMA_PAGES)
        assert executed(listings.list_schemas(pages)).count("from_json") == 1

    def test_known_ids_are_read_alone(self, stored, no_broadcast):
        plan = executed(upsert_small_batch(stored["metadata"], keyed(stored["inventory"])))
        assert f"FileScan parquet [{fv.RECORD_ID}#" in plan and re.search(
            rf"FileScan parquet \[{fv.RECORD_ID}#\d+L\]", plan
        )


class TestShuffles:
    def test_upsert(self, stored, no_broadcast):
        plan = executed(upsert_metadata(stored["metadata"], keyed(stored["inventory"])))
        assert shuffles(plan) == 2

    def test_status_log(self, stored, no_broadcast):
        log = stored["metadata"].select(fv.RECORD_ID, *schemas.SYNC)
        plan = executed(apply_status(stored["metadata"], log))
        assert shuffles(plan) == 2 and "partial_max" in plan

    def test_a_small_batch_leaves_the_metadata_where_it_is(self, stored):
        batch = keyed(stored["inventory"].limit(100))
        plan = final(upsert_small_batch(stored["metadata"], batch))
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3

    def test_most_tags_pass_through(self, stored, no_broadcast):
        new = stored["tags"].filter("table_name = 'none'")
        plan = executed(set_default_tags(stored["tags"], new))
        assert shuffles(plan) == 2 and "Union" in plan

    def test_page_counts_are_computed_once(self, stored, no_broadcast):
        assert "ReusedExchange" in final(nest(stored["inventory"]))


class TestSkew:
    def test_view(self, stored, skew):
        view = enriched_view(stored["metadata"], stored["tags"])
        assert "skew=true" in final(view)
        assert view.count() == 30_000
        assert view.filter(F.col(fv.SYNC_FLAG) == "true").count() == 30_000

    def test_nest(self, stored, skew):
        nested = nest(stored["inventory"], page_size=100)
        assert "skew=true" in final(nested)
        hot = nested.select(F.explode("schemas").alias("s")).filter("s.uc_name = 'hot'")
        assert hot.select(F.max(F.size("s.tables"))).first()[0] < 300
        assert hot.select(F.sum(F.size("s.tables"))).first()[0] == 10_000

    def test_look_up(self, spark, stored, skew):
        entities = stored["inventory"].select(
            F.col(fv.CATALOG_NAME).alias("catalog_name"),
            F.col(fv.SCHEMA_NAME).alias("schema_name"),
            F.col(fv.TABLE_ID).alias("table_name"),
            F.col(fv.TABLE_ID).alias("table_id"),
            F.col(fv.TABLE_LOCATION).alias("storage_location"),
            F.col(fv.TABLE_TYPE).alias("table_type"),
        )
        names = entities.select("catalog_name", "schema_name").distinct()
        schema_table = names.withColumn("schema_id", F.col("schema_name"))
        catalogs = spark.createDataFrame(
            [("cat", "s3://0a1b2c3d-4e5f-6071-8293-a4b5c6d7e8f9")], "catalog_name string, storage_location string"
        )
        facts = look_up_tables(
            entities.select(*schemas.TAG_KEYS), names, catalogs, schema_table, entities
        )
        assert "skew=true" in final(facts)
        assert facts.filter("table_id IS NOT NULL AND schema_id IS NOT NULL").count() == 30_000

    def test_a_much_tagged_table_is_combined_before_the_shuffle(self, spark, stored, no_broadcast):
        plan = executed(enriched_view(stored["metadata"], stored["tags"]))
        assert plan.count("partial_max") >= 5

    def test_view_is_the_same_with_and_without(self, spark, stored, conf):
        view = enriched_view(stored["metadata"].filter("uc_table_id < 500"), stored["tags"])
        plain = bag(view, fv.RECORD_ID, *schemas.TAG_NAMES)
        conf(**{"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})
        again = enriched_view(stored["metadata"].filter("uc_table_id < 500"), stored["tags"])
        assert bag(again, fv.RECORD_ID, *schemas.TAG_NAMES) == plain


class TestHelperColumns:
    def test_a_users_columns_stay(self, spark):
        from metaloom.operators.joins import skew_safe_join

        left = spark.createDataFrame([(1, "a", "b", "c"), (2, "d", "e", "f")], "k int, _key_hash string, _KEY_HASH_ string, v string")
        right = spark.createDataFrame([(1, 10)], "k int, _key_hash__ int")
        for how, want in (("inner", [(1, "a", "b", "c", 10)]), ("left", [(1, "a", "b", "c", 10), (2, "d", "e", "f", None)])):
            joined = skew_safe_join(left, right, ["k"], how)
            assert joined.columns == ["k", "_key_hash", "_KEY_HASH_", "v", "_key_hash__"] and bag(joined) == want
        assert bag(skew_safe_join(left, right, ["k"], "left_anti")) == [(2, "d", "e", "f")]
