"""The public methods: refresh metadata, tag tables, render and run statements.

Method names are fixed by existing callers. Where a caller used to get a list, a method
returns a DataFrame; where it connected to a warehouse, it takes a ``connect`` function that
runs on executors (see ``operators.apply``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.functions.outcomes import table_status
from metaloom.functions.text import quoted
from metaloom.operators import inventory as inv
from metaloom.operators.apply import STATEMENT_ID, Execute, read_ledger, run_durably
from metaloom.operators.hierarchy import nest
from metaloom.operators.keys import keyed
from metaloom.operators.merge import changed_rows, latest_status, update_status, upsert_metadata
from metaloom.operators.outcomes import container_outcomes, integration_outcomes, table_outcomes
from metaloom.operators.statements import (
    database_statements,
    integration_statements,
    schema_statements,
    table_statements,
)
from metaloom.operators.tags import default_tags, set_default_tags, untagged_tables
from metaloom.operators.targets import (
    eligible_tables,
    integration_targets,
    target_databases,
    target_schemas,
)
from metaloom.operators.view import create_view, enriched_view
from metaloom.plans.colocated import Buckets, colocate, view_of
from metaloom.plans.partitions import PartitionedTable
from metaloom.session import stage, warehouse_root
from metaloom.sources import listings


@dataclass
class LandedCatalog:
    """What was fetched from the source catalog: listing pages and entity tables."""

    schema_pages: DataFrame
    table_pages: DataFrame
    catalogs: DataFrame
    schemas: DataFrame
    tables: DataFrame

    def of(self, catalog: str) -> LandedCatalog:
        """The rows of one catalog; the filter reaches each scan."""
        return LandedCatalog(
            *(
                df.filter(F.col("catalog_name") == catalog)
                for df in (
                    self.schema_pages,
                    self.table_pages,
                    self.catalogs,
                    self.schemas,
                    self.tables,
                )
            )
        )


class CatalogMirror:
    """Keeps a metadata table of a source catalog and mirrors its tables elsewhere."""

    def __init__(
        self,
        spark_session: SparkSession,
        workspace_url: str,
        landed: LandedCatalog,
        metadata_catalog: str,
        metadata_schema: str,
        metadata_table: str = fv.METADATA_TABLE,
        tag_table: str = "table_tags",
        location: str | None = None,
    ) -> None:
        self.spark = spark_session
        self.workspace_url = workspace_url
        self.landed = landed
        place = (spark_session, metadata_catalog, metadata_schema)
        location = location or f"{warehouse_root(spark_session)}/{metadata_schema}"
        self.metadata = PartitionedTable(
            *place,
            metadata_table,
            schemas.METADATA,
            fv.CATALOG_ID,
            location,
            "Metadata of mirrored tables. Maintained by a job, not by hand.",
            sub_by=fv.SCHEMA_ID,
        )
        self.tags = PartitionedTable(
            *place,
            tag_table,
            schemas.TAGS,
            "catalog_name",
            location,
            "Tags of source tables, one row per table and tag.",
            sub_by="schema_name",
        )
        self._copies: dict[str, Buckets] = {}
        self._dropped: list[str] = []
        self.view_name = quoted(metadata_catalog, metadata_schema, metadata_table + fv.VIEW_SUFFIX)

    # Tables

    def create_metadata_tables(self) -> None:
        """Create the metadata and tag tables unless they exist, and store the view, whose definition is replaced.

        A change that was stopped while it was put in place is finished.
        """
        self.metadata.create()
        self.tags.create()
        comment = "Metadata of mirrored tables with their tags and links."
        create_view(self.spark, self.view_name, self.metadata.name, self.tags.name, comment)

    def view(self) -> DataFrame:
        """The enriched view of the current metadata and tags, as the stored view shows it by name."""
        if self._copies:
            return view_of(self._copies["metadata"], self._copies["tags"])
        return enriched_view(self.metadata.read(), self.tags.read())

    def colocate(self, buckets: int | None = None) -> None:
        """Copy metadata and tags into buckets of the table names, for ``view`` to read without exchanging them.

        Worth one shuffle of both where the view is read several times between changes, as by the methods that render
        statements. The copies show the tables as they are now, and are dropped by the next change this mirror makes;
        call it again after changes made elsewhere.
        """
        self._drop_copies()
        place, location = self.metadata, f"{self.metadata.location}/buckets"
        tables = {"metadata": (place.read(), schemas.SOURCE_NAMES), "tags": (self.tags.read(), schemas.TAG_KEYS)}
        self._copies = colocate(self.spark, place.catalog, place.schema, location, tables, buckets)

    def _drop_copies(self) -> None:
        self._dropped += [copy.drop() for copy in self._copies.values()]
        self._copies = {}

    # Refresh

    def _facts(self, catalog: str, schema: str | Sequence[str] | None, table: str | None):
        landed = self.landed.of(catalog)
        if schema is None:
            wanted = inv.wanted_schemas(listings.list_schemas(landed.schema_pages))
        else:  # named schemas need not be listed
            known = landed.schemas.select("catalog_name", "schema_name").distinct()
            wanted = inv.wanted_schemas(known, schema)
        tables = listings.list_tables(landed.table_pages)
        if table is not None:
            tables = tables.filter(F.col("table_name") == table)
        facts = inv.look_up_tables(tables, wanted, landed.catalogs, landed.schemas, landed.tables)
        return landed, wanted, facts

    def refresh_uc_metadata(
        self,
        catalog: str,
        schema: str | Sequence[str] | None = None,
        table: str | None = None,
    ) -> DataFrame:
        """Merge a catalog's current tables into the metadata table; returns rejected rows.

        ``schema`` is a name or several. Rejects are unreadable pages of wanted schemas, tables that
        lack an id, a location or a type, and named schemas that no entity is known of. They are
        not merged and do not stop the others. Only rows that differ from what is stored are merged, so a refresh
        without changes writes nothing.
        """
        self.create_metadata_tables()
        landed, _, facts = self._facts(catalog, schema, table)
        facts = stage(facts, "refresh")
        rejects = stage(inv.rejects(facts).unionByName(self._unread(landed, catalog, schema)), "rejects")
        batch = keyed(inv.inventory(facts))
        known = self.metadata.part_of(self.metadata.touched(batch))
        changed = stage(changed_rows(known, batch), "changed")
        self.metadata.rewrite(changed, lambda known: upsert_metadata(known, changed))
        self._drop_copies()
        return rejects

    def _unread(self, landed: LandedCatalog, catalog: str, schema: str | Sequence[str] | None) -> DataFrame:
        """Unreadable pages that a refresh would have needed, breaks in the chains of pages that come with their
        tokens, and named schemas without an entity."""
        pages = inv.wanted_schemas(landed.table_pages, schema)
        rejected = listings.rejected_table_pages(pages)
        if listings.PAGE_TOKEN in pages.columns:
            rejected = rejected.unionByName(listings.broken_table_listings(pages))
        if schema is None:
            rejected = rejected.unionByName(listings.rejected_schema_pages(landed.schema_pages))
            if listings.PAGE_TOKEN in landed.schema_pages.columns:
                rejected = rejected.unionByName(listings.broken_schema_listings(landed.schema_pages))
            return rejected
        names = [schema] if isinstance(schema, str) else list(schema)
        asked = self.spark.createDataFrame([(catalog, n) for n in names], "catalog_name string, schema_name string")
        unknown = asked.join(landed.schemas, ["catalog_name", "schema_name"], "left_anti").distinct()
        return rejected.unionByName(
            unknown.select(
                "*", F.lit(None).cast("string").alias("table_name"), F.lit("schema is not known").alias("reason")
            )
        )

    def unused_folders(self) -> list[str]:
        """Folders that this mirror's changes have replaced, for deletion once nobody reads them."""
        return [*self.metadata.unused, *self.tags.unused, *self._dropped]

    def build_hierarchy_for_schema(self, catalog_name: str, schema_name: str) -> DataFrame:
        """One schema and its tables, nested."""
        return self.build_hierarchy_for_catalog(catalog_name, schema_name)

    def build_hierarchy_for_catalog(
        self,
        catalog_name: str,
        schemas_include: str | Sequence[str] | None = None,
        include_empty_schemas: bool = True,
    ) -> DataFrame:
        """A catalog's schemas and tables, nested (see ``operators.hierarchy``)."""
        landed, wanted, facts = self._facts(catalog_name, schemas_include, None)
        listed = inv.schemas_of(inv.look_up_schemas(wanted, landed.catalogs, landed.schemas))
        return nest(inv.inventory(facts), listed, include_empty_schemas)

    def refresh_uc_metadata_tags(self) -> None:
        """Give each table without mapping tags the default ones."""
        new_tags = stage(default_tags(untagged_tables(self.view())), "tags")
        self.tags.rewrite(new_tags, lambda known: set_default_tags(known, new_tags))
        self._drop_copies()

    # Integrations

    def generate_create_sf_catalog_integrations_sql(
        self,
        oauth_client_id: str,
        refresh_interval_seconds: int = fv.REFRESH_INTERVAL_SECONDS,
        access_delegation_mode: str = fv.ACCESS_DELEGATION_MODE,
    ) -> DataFrame:
        """Integration statements: ``object_name, statement``."""
        return integration_statements(
            integration_targets(self.view()),
            self.workspace_url,
            oauth_client_id,
            refresh_interval_seconds,
            access_delegation_mode,
        )

    def create_sf_catalog_integrations(
        self,
        connect: Callable[[], Execute],
        oauth_client_id: str,
        refresh_interval_seconds: int = fv.REFRESH_INTERVAL_SECONDS,
        access_delegation_mode: str = fv.ACCESS_DELEGATION_MODE,
        **run: object,
    ) -> DataFrame:
        """Run the integration statements; returns outcomes with a ``result``."""
        statements = self.generate_create_sf_catalog_integrations_sql(
            oauth_client_id, refresh_interval_seconds, access_delegation_mode
        )
        outcomes = self._durable("integrations", statements, connect, **run)
        self._close("integrations")
        return integration_outcomes(outcomes)

    # Runs

    def _ledger(self, kind: str) -> str:
        """The folder of the outcomes of a run, noted with the table until the run is over."""
        key = f"metaloom.run.{kind}"
        folder = self.metadata.properties().get(key)
        if folder is None:
            folder = f"{self.metadata.location}/{self.metadata.table}-{kind}-{uuid.uuid4().hex}"
            self.metadata.set_property(key, folder)
        return folder

    def _durable(self, kind: str, statements: DataFrame, connect: Callable[[], Execute], **run: object) -> DataFrame:
        return run_durably(statements, connect, f"{self._ledger(kind)}/{kind}", **run)

    def _close(self, kind: str) -> None:
        self.metadata.set_property(f"metaloom.run.{kind}", None)

    # Tables in the warehouse

    def _eligible(self, keep: Sequence[str] = ()) -> DataFrame:
        return eligible_tables(self.view(), unique_records=True, keep=keep)

    def generate_create_sf_iceberg_tables_sql(self, auto_refresh: bool = True) -> DataFrame:
        """Table statements: ``<record id>, object_name, statement``."""
        return table_statements(self._eligible(), auto_refresh)

    def create_sf_iceberg_tables(
        self,
        sf_account_id: str,
        connect: Callable[[], Execute],
        auto_refresh: bool = True,
        create_database: bool = True,
        create_schema: bool = True,
        **run: object,
    ) -> DataFrame:
        """Create missing databases and schemas, then tables, and record each table's status.

        Returns the outcomes of all statements with a ``result``. Outcomes are kept as tasks end (see
        ``operators.apply.run_durably``). If a run fails, the next call goes on with it: statements that were
        finished in that account are not run again, and their statuses are recorded with the others.
        ``record_outcomes`` records them without running any.
        """
        account = F.lit(sf_account_id).alias(fv.ACCOUNT)
        tables = stage(self._eligible(_DEALT_BY), "eligible")
        containers = []
        if create_database:
            containers.append(("databases", database_statements(target_databases(tables))))
        if create_schema:
            containers.append(("schemas", schema_statements(target_schemas(tables))))
        created_containers = [
            container_outcomes(self._run_part(part, s.select("*", account), connect, **run)) for part, s in containers
        ]
        statements = table_statements(tables, auto_refresh, keep=_DEALT_BY).select("*", account)
        created = stage(self._run_part("tables", statements, connect, **run), "tables")
        self.record_outcomes()
        self._close("tables")
        result = created.drop(*_DEALT_BY).withColumn("result", table_status(F.col("error")))
        for more in created_containers:
            result = result.unionByName(more, allowMissingColumns=True)
        return result.drop(fv.ACCOUNT)

    def _run_part(self, part: str, statements: DataFrame, connect: Callable[[], Execute], **run: object) -> DataFrame:
        return run_durably(statements, connect, f"{self._ledger('tables')}/{part}", **run)

    def record_outcomes(self) -> int:
        """Record the statuses of what an unfinished run of ``create_sf_iceberg_tables`` has finished; how many."""
        statements = table_statements(self._eligible(_DEALT_BY), keep=_DEALT_BY)
        ledger = f"{self._ledger('tables')}/tables"
        finished = read_ledger(statements.withColumn(fv.ACCOUNT, F.lit("")), ledger)
        finished = stage(finished.drop(STATEMENT_ID), "finished")
        outcomes = table_outcomes(finished, F.col(fv.ACCOUNT), F.current_timestamp(), keep=("applied_at",))
        status = latest_status(outcomes, ("applied_at",))
        self.metadata.rewrite(finished.select(*_DEALT_BY), lambda known: update_status(known, status))
        self._drop_copies()
        return finished.select(fv.RECORD_ID).distinct().count()


#: Columns that tell where a record is stored; outcomes carry them, so that a status finds its partition.
_DEALT_BY = (fv.CATALOG_ID, fv.SCHEMA_ID)
