"""The registered queries: every operator over the whole of the given tables.

Record ids and integration names are hashes that SQL engines do not share. Queries whose
rows hold them show the natural key in their place; ``record_keys`` checks the hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.functions.attributes import uuid_in
from metaloom.operators import inventory as inv
from metaloom.operators.apply import Execute, run_durably
from metaloom.operators.hierarchy import flatten, nest
from metaloom.operators.keys import keyed
from metaloom.operators.joins import skew_safe_join
from metaloom.operators.merge import changed_rows, latest_status, update_status, upsert_metadata, upsert_small_batch
from metaloom.operators.outcomes import container_outcomes, integration_outcomes, table_outcomes
from metaloom.operators.paging import list_pages
from metaloom.operators.statements import (
    database_statements,
    integration_statements,
    not_blank,
    schema_statements,
    table_statements,
)
from metaloom.operators.tags import default_tags, pivot_tags, set_default_tags, untagged_tables
from metaloom.operators.targets import (
    eligible_tables,
    integration_targets,
    target_databases,
    target_schemas,
)
from metaloom.operators.view import enriched_view, register_view
from metaloom.plans.colocated import colocate, upsert_into
from metaloom.plans.mirror import CatalogMirror
from metaloom.plans.partitions import PART, SUB, SUBS
from metaloom.session import stage, staging_path
from metaloom.sources import listings
from metaloom.sources.tables import empty_metadata, read_metadata
from metaloom.workload import LOG_ORDER, Workload, chained_pages, dashed

Query = Callable[[SparkSession, str], DataFrame]

ENDPOINT = "https://workspace.example.com"
CLIENT_ID = "client-id"


def _without_hashes(df: DataFrame) -> DataFrame:
    shown = df.drop(fv.RECORD_ID, fv.INTEGRATION)
    if fv.SYNC_DATE in shown.columns:
        shown = shown.withColumn(fv.SYNC_DATE, F.col(fv.SYNC_DATE).cast("timestamp_ntz"))
    return shown


def _natural_integration(df: DataFrame) -> DataFrame:
    """Integration names made of the ids they would be the hash of."""
    name = F.concat(F.lit(fv.INTEGRATION_PREFIX), fv.CATALOG_ID, F.lit("_"), fv.SCHEMA_ID)
    return df.withColumn(fv.INTEGRATION, name)


def _view(w: Workload) -> DataFrame:
    return enriched_view(w.metadata(), w.tags())


def _unsynced_view(w: Workload) -> DataFrame:
    """The view right after a refresh: the same tags, no status yet."""
    return enriched_view(keyed(w.inventory()), w.tags())


def tag_pivot(w: Workload) -> DataFrame:
    return pivot_tags(w.tags())


def enriched(w: Workload) -> DataFrame:
    return _without_hashes(_view(w))


def view_sql(w: Workload) -> DataFrame:
    register_view(_view(w), fv.METADATA_TABLE + fv.VIEW_SUFFIX)
    view = w.spark.sql(f"SELECT * FROM {fv.METADATA_TABLE}{fv.VIEW_SUFFIX}")
    return _without_hashes(view)


def untagged(w: Workload) -> DataFrame:
    return _without_hashes(untagged_tables(_unsynced_view(w)))


def defaults(w: Workload) -> DataFrame:
    return default_tags(untagged_tables(_unsynced_view(w)))


def tags_after_refresh(w: Workload) -> DataFrame:
    new_tags = stage(default_tags(untagged_tables(_unsynced_view(w))), "tags")
    return set_default_tags(w.tags(), new_tags)


def integrations(w: Workload) -> DataFrame:
    return integration_targets(_natural_integration(_unsynced_view(w)))


def eligible(w: Workload) -> DataFrame:
    return eligible_tables(_natural_integration(_unsynced_view(w))).drop(fv.RECORD_ID)


def databases(w: Workload) -> DataFrame:
    return target_databases(eligible_tables(_unsynced_view(w), unique_records=True))


def target_schema_pairs(w: Workload) -> DataFrame:
    return target_schemas(eligible_tables(_unsynced_view(w), unique_records=True))


def hierarchy_nest(w: Workload) -> DataFrame:
    """Per schema what the nested rows hold, empty schemas included."""
    node = nest(w.inventory(), w.schema_rows()).select("uc_name", F.explode("schemas").alias("s"))
    names = F.col("s.tables.uc_name")
    return node.groupBy(
        F.col("uc_name").alias("catalog_name"), F.col("s.uc_name").alias("schema_name")
    ).agg(
        F.sum(F.size("s.tables")).alias("n_tables"),
        F.min(F.array_min(names)).alias("first_table"),
        F.max(F.array_max(names)).alias("last_table"),
    )


def hierarchy_flatten(w: Workload) -> DataFrame:
    return flatten(nest(w.inventory(), w.schema_rows()))


def tables_per_schema(w: Workload) -> DataFrame:
    return inv.tables_per_schema(w.schema_rows(), w.inventory()).select(
        fv.CATALOG_NAME, fv.SCHEMA_NAME, "n_tables"
    )


def _facts(w: Workload) -> DataFrame:
    landed = w.landed()
    wanted = inv.wanted_schemas(listings.list_schemas(landed.schema_pages))
    tables = listings.list_tables(landed.table_pages)
    return inv.look_up_tables(tables, wanted, landed.catalogs, landed.schemas, landed.tables)


def inventory_from_pages(w: Workload) -> DataFrame:
    return inv.inventory(_facts(w))


def listed_schemas(w: Workload) -> DataFrame:
    return inv.wanted_schemas(listings.list_schemas(w.landed().schema_pages))


def included_schemas(w: Workload) -> DataFrame:
    """Tables of the schemas in an include list, which here is a table of its own."""
    include = w.table("customer").filter(F.col("c_mktsegment") == "BUILDING")
    listed = w.table_entities().select("catalog_name", "schema_name", "table_name")
    return inv.wanted_schemas(listed, include.select(F.col("c_name").alias("schema_name")))


def entity_lookup_join(w: Workload) -> DataFrame:
    """Entities looked up for listed tables; catalogs of one region have no id and reject."""
    nation = w.table("nation").select(F.col("n_name").alias("catalog_name"), "n_regionkey")
    located = w.catalog_entities().join(nation, "catalog_name")
    catalogs = located.select(
        "catalog_name",
        F.when(F.col("n_regionkey") == 0, "s3://lake/no-id-here")
        .otherwise(F.col("storage_location"))
        .alias("storage_location"),
    )
    tables, entities = w.table_entities(), w.schema_entities()
    facts = inv.look_up_tables(
        tables.select(*schemas.TAG_KEYS), entities.select("catalog_name", "schema_name"),
        catalogs, entities, tables,
    )
    found = inv.inventory(facts).select(
        *schemas.SOURCE_NAMES, fv.TABLE_ID, F.lit(None).cast("string").alias("reason")
    )
    return found.unionByName(
        inv.rejects(facts).select(
            *(F.col(k).alias(n) for k, n in zip(schemas.TAG_KEYS, schemas.SOURCE_NAMES)),
            F.lit(None).cast("string").alias(fv.TABLE_ID),
            "reason",
        )
    )


def rejected_pages(w: Workload) -> DataFrame:
    """Bodies that are no listings among bodies that are: web pages among listing pages."""
    web = w.table("pages").select(
        F.col("url").alias("catalog_name"), F.lit("web").alias("schema_name"), F.col("html").alias("body")
    )
    return listings.rejected_table_pages(w.landed().table_pages.unionByName(web))


def catalog_uuid(w: Workload) -> DataFrame:
    """Ids in locations that hold one, two or none."""
    first = dashed(F.md5(F.col("o_orderkey").cast("string")))
    second = dashed(F.md5(F.col("o_custkey").cast("string")))
    location = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("s3://lake/"), first))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("s3://lake/"), first, F.lit("/x/"), second))
        .otherwise(F.concat(F.lit("s3://LAKE/"), F.col("o_orderkey").cast("string")))
    )
    return w.table("orders").select("o_orderkey", uuid_in(location).alias("catalog_id"))


def record_keys(w: Workload) -> DataFrame:
    """Per catalog: as many hashed keys as natural ones, and none negative."""
    return (
        keyed(w.inventory())
        .groupBy(fv.CATALOG_NAME)
        .agg(
            F.count("*").alias("n_tables"),
            F.countDistinct(fv.RECORD_ID).alias("n_records"),
            F.countDistinct(fv.INTEGRATION).alias("n_integrations"),
            (F.min(fv.RECORD_ID) >= 0).alias("non_negative"),
        )
    )


def _merge_inputs(w: Workload) -> tuple[DataFrame, DataFrame]:
    """A table that knows all but the P orders, and a batch of all but the F orders, renamed."""
    known = w.metadata("o_orderstatus <> 'P'")
    renamed = w.inventory("o_orderstatus").filter("o_orderstatus <> 'F'").select(
        *schemas.SOURCE_IDS,
        fv.CATALOG_NAME,
        F.upper(F.col(fv.SCHEMA_NAME)).alias(fv.SCHEMA_NAME),
        F.concat(F.col(fv.TABLE_NAME), F.lit("_new")).alias(fv.TABLE_NAME),
        F.concat(F.col(fv.TABLE_LOCATION), F.lit("/new")).alias(fv.TABLE_LOCATION),
        F.lit("FOREIGN").alias(fv.TABLE_TYPE),
    )
    return known, keyed(renamed)


def upsert(w: Workload) -> DataFrame:
    return _without_hashes(upsert_metadata(*_merge_inputs(w)))


def upsert_small(w: Workload) -> DataFrame:
    return _without_hashes(upsert_small_batch(*_merge_inputs(w)))


def newest_status(w: Workload) -> DataFrame:
    """The newest outcome of each table, from the raw log."""
    log = table_outcomes(w.raw_outcomes(), F.col("account"), keep=LOG_ORDER[1:])
    return latest_status(log, LOG_ORDER).withColumn(fv.SYNC_DATE, F.col(fv.SYNC_DATE).cast("timestamp_ntz"))


def status_update(w: Workload) -> DataFrame:
    return _without_hashes(w.applied())


def status_batch(w: Workload) -> DataFrame:
    """One batch with a row per table, merged into a table of O and P orders only."""
    inventory = w.inventory("o_orderstatus")
    known = keyed(inventory.filter("o_orderstatus <> 'F'"))
    batch = keyed(inventory).select(
        fv.RECORD_ID,
        F.concat(F.lit("Org-"), fv.SCHEMA_ID).alias(fv.ACCOUNT),
        F.lit(fv.STATUS_SUCCESS).alias(fv.SYNC_STATUS),
        F.concat(F.lit("applied "), fv.TABLE_NAME).alias(fv.SYNC_MESSAGE),
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias(fv.SYNC_DATE),
    )
    return _without_hashes(update_status(known, batch))


def table_results(w: Workload) -> DataFrame:
    return table_outcomes(w.raw_outcomes(), F.col("account")).withColumn(
        fv.SYNC_DATE, F.col(fv.SYNC_DATE).cast("timestamp_ntz")
    )


def _raw_results(w: Workload) -> DataFrame:
    return w.raw_outcomes().select("object_name", "error", "error_kind")


def integration_results(w: Workload) -> DataFrame:
    return integration_outcomes(_raw_results(w))


def container_results(w: Workload) -> DataFrame:
    return container_outcomes(_raw_results(w))


def render_tables(w: Workload) -> DataFrame:
    tables = eligible_tables(_natural_integration(_unsynced_view(w)), unique_records=True)
    return table_statements(tables).drop(fv.RECORD_ID)


def render_quoted_tables(w: Workload) -> DataFrame:
    tables = eligible_tables(_natural_integration(_unsynced_view(w)), unique_records=True)
    statements = table_statements(tables, auto_refresh=False, quote_identifiers=True)
    return statements.drop(fv.RECORD_ID)


def render_containers(w: Workload) -> DataFrame:
    """Databases and schemas to create, of which some have no name and so no statement."""
    tables = eligible_tables(_unsynced_view(w), unique_records=True)
    targets = (fv.TARGET_DATABASE, fv.TARGET_SCHEMA)
    tables = tables.withColumns({n: F.when(F.ascii(F.reverse(n)) % 3 != 0, F.col(n)) for n in targets})
    databases = database_statements(target_databases(tables))
    return databases.unionByName(schema_statements(target_schemas(tables)))


def render_integrations(w: Workload) -> DataFrame:
    targets = integration_targets(_natural_integration(_unsynced_view(w)))
    return integration_statements(targets, ENDPOINT, CLIENT_ID, 300)


def metadata_roundtrip(w: Workload) -> DataFrame:
    """Typed rows written below the staging folder and read back."""
    path = staging_path(w.spark, "metadata")
    empty_metadata(w.spark).unionByName(w.metadata()).write.parquet(path)
    return _without_hashes(read_metadata(w.spark, path))


def combinations_list(w: Workload) -> DataFrame:
    """Lists of packed combinations, unpacked again."""
    pages = list_pages(integration_targets(_natural_integration(_unsynced_view(w))))
    return pages.select(F.inline("combinations"))


def _mirror(w: Workload) -> CatalogMirror:
    """A mirror with tables and a view of its own, in a new schema of the session catalog."""
    schema = f"metaloom_{uuid.uuid4().hex}"
    w.spark.sql(f"CREATE SCHEMA {schema}")
    location = staging_path(w.spark, "mirror")
    mirror = CatalogMirror(w.spark, ENDPOINT, w.landed(), "spark_catalog", schema, location=location)
    mirror.create_metadata_tables()
    return mirror


def _filled_mirror(w: Workload) -> CatalogMirror:
    mirror = _mirror(w)
    w.place_orders()
    layout = (PART, SUBS, SUB)
    tables = w.inventory().withColumnsRenamed(dict(zip(schemas.SOURCE_NAMES, schemas.TAG_KEYS)))
    mirror.metadata.fill(tables, w.short_metadata(), lambda short: w.metadata_of(short, *layout))
    tags_each = w.table("lineitem").count() / max(w.table("orders").count(), 1)
    mirror.tags.fill(tables, w.short_tags(), lambda short: w.tags_of(short, *layout), tags_each)
    return mirror


def stored_view(w: Workload) -> DataFrame:
    """The stored view, read by name, over stored tables."""
    mirror = _filled_mirror(w)
    return _without_hashes(w.spark.sql(f"SELECT * FROM {mirror.view_name}"))


def stored_upsert(w: Workload) -> DataFrame:
    """A stored table after two refreshes, of which the second merges the rows that differ."""
    known, batch = _merge_inputs(w)
    batch = stage(batch, "batch")
    table = _mirror(w).metadata
    dealt_by = w.inventory(orders=w.table("orders").filter("o_orderstatus <> 'P'"))
    table.rewrite(dealt_by, lambda empty: empty.unionByName(known))
    changed = stage(changed_rows(table.part_of(table.touched(batch)), batch), "changed")
    table.rewrite(changed, lambda stored: upsert_metadata(stored, changed))
    return _without_hashes(table.read())


def view_from_buckets(w: Workload) -> DataFrame:
    """The view of stored tables that were copied into buckets of the table names."""
    mirror = _filled_mirror(w)
    mirror.colocate()
    return _without_hashes(mirror.view())


def upsert_into_buckets(w: Workload) -> DataFrame:
    """A refresh merged into a copy of the metadata in buckets of the record id."""
    known, batch = (stage(rows, "batch") for rows in _merge_inputs(w))
    place = _mirror(w).metadata
    tables = {"metadata": (known, [fv.RECORD_ID])}
    copies = colocate(w.spark, place.catalog, place.schema, place.location, tables)
    return _without_hashes(upsert_into(copies["metadata"], batch))


def _no_volumes() -> Execute:
    """A connection to a warehouse that knows no external volumes."""

    def execute(sql: str) -> None:
        if "EXTERNAL_VOLUME" in sql:
            raise ValueError("SQL compilation error: volume not found")

    return execute


def applied_statements(w: Workload) -> DataFrame:
    """Status rows of table statements, run with outcomes that outlive a failure."""
    tables = eligible_tables(_natural_integration(_unsynced_view(w)), unique_records=True)
    ledger = staging_path(w.spark, "ledger")
    outcomes = run_durably(table_statements(tables), _no_volumes, ledger, per_task=10_000)
    status = table_outcomes(outcomes, "Org-Acct", keep=("object_name", "error_kind"))
    return status.drop(fv.RECORD_ID, fv.SYNC_DATE)


def batch_stamp(w: Workload) -> DataFrame:
    """The time that a batch of outcomes is recorded under: one, and now."""
    status = table_outcomes(w.raw_outcomes(), F.col("account"), F.current_timestamp())
    away = F.abs(F.unix_timestamp(fv.SYNC_DATE) - F.unix_timestamp(F.current_timestamp()))
    return status.agg(
        F.count("*").alias("n_outcomes"),
        F.count_distinct(fv.SYNC_DATE).alias("n_stamps"),
        F.coalesce(F.max(away) < 3600, F.lit(False)).alias("is_now"),
    )


def run_inputs(w: Workload) -> DataFrame:
    """Statement rows that are run, of rows of which many are NULL, empty or white space."""
    line = F.col("l_linenumber")
    statement = (
        F.when(line == 1, "")
        .when(line == 2, " \t\n ")
        .when(line == 3, F.lit(None))
        .otherwise(F.concat(F.lit(" CREATE DATABASE db_"), F.col("l_partkey").cast("string")))
    )
    return not_blank(w.table("lineitem").select("l_orderkey", "l_linenumber", statement.alias("statement")))


def broken_listings(w: Workload) -> DataFrame:
    """What breaks chains of listing pages."""
    return listings.broken_schema_listings(chained_pages(w)).select("catalog_name", "reason")


def tags_of_untagged(w: Workload) -> DataFrame:
    """All tags that untagged tables have after the default ones were set."""
    new_tags = stage(default_tags(untagged_tables(_unsynced_view(w))), "tags")
    touched = new_tags.select(*schemas.TAG_KEYS).distinct()
    return skew_safe_join(set_default_tags(w.tags(), new_tags), touched, schemas.TAG_KEYS, "left_semi")


QUERIES: dict[str, Callable[[Workload], DataFrame]] = {
    "tag_pivot": tag_pivot,
    "enriched_view": enriched,
    "view_sql": view_sql,
    "untagged_tables": untagged,
    "default_tags": defaults,
    "tags_after_refresh": tags_after_refresh,
    "integration_targets": integrations,
    "eligible_tables": eligible,
    "target_databases": databases,
    "target_schemas": target_schema_pairs,
    "hierarchy_nest": hierarchy_nest,
    "hierarchy_flatten": hierarchy_flatten,
    "tables_per_schema": tables_per_schema,
    "inventory_from_pages": inventory_from_pages,
    "listed_schemas": listed_schemas,
    "included_schemas": included_schemas,
    "entity_lookup_join": entity_lookup_join,
    "rejected_pages": rejected_pages,
    "catalog_uuid": catalog_uuid,
    "record_keys": record_keys,
    "upsert_metadata": upsert,
    "upsert_small_batch": upsert_small,
    "latest_status": newest_status,
    "status_update": status_update,
    "status_batch": status_batch,
    "table_outcomes": table_results,
    "integration_outcomes": integration_results,
    "container_outcomes": container_results,
    "table_statements": render_tables,
    "table_statements_quoted": render_quoted_tables,
    "container_statements": render_containers,
    "integration_statements": render_integrations,
    "metadata_roundtrip": metadata_roundtrip,
    "combinations_list": combinations_list,
    "stored_view": stored_view,
    "stored_upsert": stored_upsert,
    "view_from_buckets": view_from_buckets,
    "upsert_into_buckets": upsert_into_buckets,
    "applied_statements": applied_statements,
    "batch_stamp": batch_stamp,
    "run_inputs": run_inputs,
    "broken_listings": broken_listings,
    "tags_of_untagged": tags_of_untagged,
}


def registered() -> dict[str, Query]:
    """Queries by name, each a function of session and data folder."""

    def bind(query: Callable[[Workload], DataFrame]) -> Query:
        return lambda spark, sf_dir: query(Workload(spark, sf_dir))

    return {name: bind(query) for name, query in QUERIES.items()}
