"""The public methods, end to end on hand-written listings."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.operators.hierarchy import flatten
from metaloom.plans.mirror import CatalogMirror, LandedCatalog
from metaloom.session import staging_path
from metaloom.sources.tables import typed_rows
from tests.fixtures import UUID_A, UUID_B, bag, by

TABLES = {
    ("cat", "sales"): ["orders", "items", "broken"],
    ("cat", "hr"): ["people"],
    ("cat", "information_schema"): ["tables"],
    ("dog", "sales"): ["orders"],
}


def landed(spark):
    def page(schema, names):
        identifiers = [{"namespace": [schema], "name": n} for n in names]
        return json.dumps({"identifiers": identifiers})

    namespaces = {
        c: json.dumps({"namespaces": [[s] for k, s in TABLES if k == c] + [["empty"]]})
        for c in ("cat", "dog")
    }
    table_pages = [(c, s, page(s, [n])) for (c, s), names in TABLES.items() for n in names]
    table_pages.append(("cat", "empty", "no json"))
    entities = [
        (c, s, n, f"{c}-{s}-{n}" if n != "broken" else None, f"s3://{c}/{s}/{n}", "MANAGED")
        for (c, s), names in TABLES.items()
        for n in names
    ]
    return LandedCatalog(
        typed_rows(spark, list(namespaces.items()), schemas.SCHEMA_PAGES),
        typed_rows(spark, table_pages, schemas.TABLE_PAGES),
        typed_rows(spark, [("cat", f"s3://{UUID_A}"), ("dog", f"s3://{UUID_B}")], schemas.CATALOG_ENTITIES),
        typed_rows(
            spark,
            [(c, s, f"{c}-{s}") for c, s in TABLES] + [("cat", "empty", "e"), ("dog", "empty", "e")],
            schemas.SCHEMA_ENTITIES,
        ),
        typed_rows(spark, entities, schemas.TABLE_ENTITIES),
    )


@pytest.fixture
def mirror(spark):
    mark = uuid.uuid4().hex
    return CatalogMirror(
        spark,
        "https://w",
        landed(spark),
        "spark_catalog",
        "default",
        metadata_table=f"meta_{mark}",
        tag_table=f"tags_{mark}",
        location=staging_path(spark, "mirror"),
    )


def names(df):
    return bag(df, *schemas.SOURCE_NAMES)


CAT = [("cat", "hr", "people"), ("cat", "sales", "items"), ("cat", "sales", "orders")]


def test_refresh(mirror):
    rejected = mirror.refresh_uc_metadata("cat")
    assert names(mirror.metadata.read()) == CAT
    assert bag(rejected, "schema_name", "table_name", "reason") == [
        ("empty", None, "page is no listing: no json"),
        ("sales", "broken", "table has no id"),
    ]
    mirror.refresh_uc_metadata("cat")
    mirror.refresh_uc_metadata("dog")
    assert names(mirror.metadata.read()) == [*CAT, ("dog", "sales", "orders")]


@pytest.mark.parametrize(
    "schema, table, expected",
    [
        ("hr", None, CAT[:1]),
        (["hr", "sales"], None, CAT),
        ("sales", "orders", CAT[2:]),
        (None, "people", CAT[:1]),
        ("none", None, []),
        ("information_schema", None, [("cat", "information_schema", "tables")]),
    ],
)
def test_refresh_of_a_part(mirror, schema, table, expected):
    mirror.refresh_uc_metadata("cat", schema, table)
    assert names(mirror.metadata.read()) == expected


def test_rejects_follow_the_request(mirror):
    assert mirror.refresh_uc_metadata("cat", "hr").count() == 0
    rejected = mirror.refresh_uc_metadata("cat", ["typo", "typo", "sales"])
    assert bag(rejected, "schema_name", "table_name", "reason") == [
        ("sales", "broken", "table has no id"),
        ("typo", None, "schema is not known"),
    ]


def test_replaced_folders_are_known(mirror):
    mirror.refresh_uc_metadata("cat")
    assert mirror.unused_folders() == []
    before = list(mirror.metadata.folders().values())
    mirror.landed.tables = mirror.landed.tables.withColumn("table_type", F.lit("EXTERNAL"))
    mirror.refresh_uc_metadata("cat")
    assert mirror.unused_folders() == before


def test_hierarchy_of_a_schema(mirror):
    nested = mirror.build_hierarchy_for_schema("cat", "hr")
    assert names(flatten(nested)) == CAT[:1]


def test_named_schemas_need_not_be_listed(spark, mirror):
    mirror.landed.schema_pages = mirror.landed.schema_pages.limit(0)
    mirror.refresh_uc_metadata("cat")
    assert names(mirror.metadata.read()) == []
    mirror.refresh_uc_metadata("cat", ["hr"])
    assert names(mirror.metadata.read()) == CAT[:1]


def test_refresh_rewrites_its_catalog_only(mirror):
    mirror.refresh_uc_metadata("cat")
    (cat,) = mirror.metadata.folders().values()
    mirror.refresh_uc_metadata("dog")
    folders = set(mirror.metadata.folders().values())
    assert cat in folders and len(folders) == 2
    mirror.landed.tables = mirror.landed.tables.withColumn("table_type", F.lit("EXTERNAL"))
    mirror.refresh_uc_metadata("cat")
    assert len(folders & set(mirror.metadata.folders().values())) == 1


def test_hierarchy(mirror):
    nested = mirror.build_hierarchy_for_catalog("cat")
    assert {s.uc_name: len(s.tables) for r in nested.collect() for s in r.schemas} == {
        "sales": 2, "hr": 1, "empty": 0,
    }
    assert names(flatten(nested)) == CAT
    nested = mirror.build_hierarchy_for_catalog("cat", ["hr", "empty"], include_empty_schemas=False)
    assert [s.uc_name for r in nested.collect() for s in r.schemas] == ["hr"]


def test_tags_statements_and_sync(spark, mirror):
    mirror.refresh_uc_metadata("cat")
    assert mirror.generate_create_sf_iceberg_tables_sql().count() == 0
    mirror.refresh_uc_metadata_tags()
    assert mirror.tags.read().count() == 15
    mirror.refresh_uc_metadata_tags()
    assert mirror.tags.read().count() == 15

    statements = by(mirror.generate_create_sf_iceberg_tables_sql(auto_refresh=False), "object_name")
    assert set(statements) == {"items", "orders", "people"}
    assert statements["people"]["statement"].startswith("CREATE ICEBERG TABLE cat.hr.people IF NOT EXISTS\n")
    assert statements["people"]["statement"].endswith("AUTO_REFRESH = FALSE;")

    integrations = mirror.generate_create_sf_catalog_integrations_sql("me", 120)
    assert integrations.count() == 2
    assert "REFRESH_INTERVAL_SECONDS = 120;" in integrations.first().statement

    def connect():
        def execute(sql):
            if sql.startswith("CREATE SCHEMA cat.hr"):
                raise ValueError("conflict")
            if "cat.sales.items" in sql:
                raise ValueError("denied")
            if "NAMESPACE = 'hr'" in sql:
                raise ValueError("integration already exists")

        return execute

    def kind(error):
        return "conflict" if "conflict" in str(error) else "compile"

    outcomes = mirror.create_sf_catalog_integrations(connect, "me", error_kind=kind)
    assert bag(outcomes, "result") == [("error",), ("error",)]  # the secret is not known
    secrets = lambda: {"OAUTH_CLIENT_SECRET": "hidden-0"}
    outcomes = mirror.create_sf_catalog_integrations(connect, "me", error_kind=kind, secrets=secrets)
    assert bag(outcomes, "result") == [("created",), ("skipped",)]

    outcomes = mirror.create_sf_iceberg_tables("Org-Acct", connect, connections=2, error_kind=kind)
    assert bag(outcomes, "object_name", "result") == [
        ("cat", "created"),
        ("cat.hr", "already exists"),
        ("cat.sales", "created"),
        ("items", "failed"),
        ("orders", "success"),
        ("people", "success"),
    ]
    view = by(spark.table(mirror.metadata.table + fv.VIEW_SUFFIX), fv.TABLE_NAME)
    assert view["people"][fv.LINK].startswith(fv.LINK_HOST + "org/acct/#/data/databases/CAT/")
    assert view["items"][fv.SYNC_STATUS] == "failed" and view["items"][fv.LINK] is None
    assert view["items"][fv.SYNC_MESSAGE] == "SQL compilation error: denied"
    assert len({r[fv.SYNC_DATE] for r in view.values()}) == 1

    before = bag(mirror.metadata.read())
    mirror.refresh_uc_metadata("cat")
    assert bag(mirror.metadata.read()) == before


def test_switched_off_tables_are_not_synced(spark, mirror):
    mirror.refresh_uc_metadata("dog")
    mirror.refresh_uc_metadata_tags()
    off = F.when(F.col("tag_name") == fv.SYNC_FLAG, "false").otherwise(F.col("tag_value"))
    mirror.tags.rewrite(mirror.tags.read(), lambda known: known.withColumn("tag_value", off))

    def connect():
        raise RuntimeError("nothing to do")

    assert mirror.create_sf_iceberg_tables("Org-Acct", connect).count() == 0
    assert mirror.metadata.read().filter(F.col(fv.SYNC_STATUS).isNotNull()).count() == 0


def files(mirror):
    return sorted(r[0] for r in mirror.metadata.read().select("_metadata.file_path").distinct().collect())


def test_an_equal_refresh_writes_nothing(spark, mirror):
    mirror.refresh_uc_metadata("cat")
    before = {p: f for p, f in mirror.metadata.folders().items()}
    rejected = mirror.refresh_uc_metadata("cat")
    assert mirror.metadata.folders() == before and mirror.unused_folders() == [] and rejected.count() == 2
    renamed = F.when(F.col("table_name") == "people", "EXTERNAL").otherwise(F.col("table_type"))
    mirror.landed.tables = mirror.landed.tables.withColumn("table_type", renamed)
    mirror.refresh_uc_metadata("dog")
    mirror.refresh_uc_metadata("cat")
    assert bag(mirror.metadata.read(), fv.TABLE_NAME, fv.TABLE_TYPE) == [
        ("items", "MANAGED"), ("orders", "MANAGED"), ("orders", "MANAGED"), ("people", "EXTERNAL"),
    ]


def test_views_of_two_mirrors(spark, mirror):
    """Each has its own view by name, which other sessions read and which follows the tables."""
    mark = f"other_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {mark}")
    other = CatalogMirror(
        spark, "https://w", landed(spark), "spark_catalog", mark,
        metadata_table=mirror.metadata.table, tag_table=mirror.tags.table, location=staging_path(spark, "mirror"),
    )
    mirror.refresh_uc_metadata("cat")
    other.refresh_uc_metadata("dog")
    other.refresh_uc_metadata_tags()
    session = spark.newSession()

    def shown(schema):
        return session.sql(f"SELECT * FROM spark_catalog.{schema}.{mirror.metadata.table}{fv.VIEW_SUFFIX}")

    assert names(shown("default")) == CAT and names(shown(mark)) == [("dog", "sales", "orders")]
    assert bag(shown(mark)) == bag(other.view()) and shown(mark).schema.names == schemas.VIEW.names
    mirror.create_metadata_tables()
    mirror.refresh_uc_metadata_tags()
    assert bag(shown("default")) == bag(mirror.view())
    assert bag(shown("default"), fv.TARGET_TABLE) == [("items",), ("orders",), ("people",)]


def test_a_stale_view_is_replaced(spark, mirror):
    spark.sql(f"CREATE VIEW {mirror.view_name} AS SELECT 1 AS a")
    mirror.refresh_uc_metadata("dog")
    assert spark.table(mirror.view_name).columns == schemas.VIEW.names


def test_a_failed_run_is_gone_on_with(spark, mirror, tmp_path):
    mirror.refresh_uc_metadata("cat")
    mirror.refresh_uc_metadata_tags()
    noted = str(tmp_path)

    def connecting(broken):
        def connect():
            def execute(sql):
                if "cat.sales.items" in sql and broken:
                    raise SystemExit("cut off")
                with open(f"{noted}/{uuid.uuid4().hex}", "w") as file:
                    file.write(sql.split("\n")[0])

            return execute

        return connect

    def runs():
        return sorted(p.read_text() for p in tmp_path.iterdir())

    with pytest.raises(RuntimeError, match="cut off"):
        mirror.create_sf_iceberg_tables("Org-Acct", connecting(True), connections=1, per_task=1)
    first = runs()
    assert "CREATE DATABASE cat" in first and not any("items" in sql for sql in first)
    done = mirror.record_outcomes()
    synced = mirror.metadata.read().filter(F.col(fv.SYNC_STATUS).isNotNull())
    assert synced.count() == done == sum("ICEBERG" in sql for sql in first)
    outcomes = mirror.create_sf_iceberg_tables("Org-Acct", connecting(False), connections=1, per_task=1)
    assert outcomes.filter("result = 'success'").count() == 3
    assert outcomes.columns == [fv.RECORD_ID, "object_name", "error", "error_kind", "applied_at", "result"]
    assert len(runs()) == len(set(runs())) == 6  # nothing ran twice
    assert mirror.metadata.read().filter(f"{fv.SYNC_STATUS} = 'success'").count() == 3
    mirror.create_sf_iceberg_tables("Org-Acct", connecting(False))
    assert len(runs()) == 12  # a run of its own


def test_statuses_find_their_partitions(spark, mirror, monkeypatch):
    """Recording reads the partitions that the outcomes name, not the table."""
    mirror.refresh_uc_metadata("cat")
    mirror.refresh_uc_metadata("dog")
    mirror.refresh_uc_metadata_tags()
    off = F.when(F.col("catalog_name") == "cat", "false").otherwise(F.col("tag_value"))
    off = F.when(F.col("tag_name") == fv.SYNC_FLAG, off).otherwise(F.col("tag_value"))
    mirror.tags.rewrite(mirror.tags.read(), lambda known: known.withColumn("tag_value", off))
    before, plans = mirror.metadata.folders(), []
    part_of = type(mirror.metadata).part_of

    def watched(self, places):
        plans.append(part_of(self, places)._jdf.queryExecution().executedPlan().toString())
        return part_of(self, places)

    monkeypatch.setattr(type(mirror.metadata), "part_of", watched)
    mirror.create_sf_iceberg_tables("Org-Acct", lambda: lambda sql: None)
    assert len(plans) == 1 and "PartitionFilters: [" in plans[0] and "InMemoryFileIndex(1 paths)" in plans[0]
    after = mirror.metadata.folders()
    assert len(before) == 2 and len([p for p in after if after[p] != before[p]]) == 1


def test_a_missing_page_is_a_reject(spark, mirror):
    token = F.when(F.col("body").contains("items"), "p2")
    following = F.when(F.col("body").contains("orders"), F.regexp_replace("body", "}$", ', "next-page-token": "p2"}'))
    pages = mirror.landed.table_pages.withColumn("page_token", token)
    pages = pages.withColumn("body", F.coalesce(F.when(F.col("catalog_name") == "cat", following), "body"))
    pages = pages.filter("body NOT LIKE '%broken%'")
    mirror.landed.table_pages = pages
    expected = [("empty", "page is no listing: no json")]
    assert bag(mirror.refresh_uc_metadata("cat"), "schema_name", "reason") == expected
    mirror.landed.table_pages = pages.filter("page_token IS NULL")
    assert bag(mirror.refresh_uc_metadata("cat"), "schema_name", "reason") == [*expected, ("sales", "listing: page p2 is missing")]
    assert names(mirror.metadata.read()) == CAT


def test_copies_show_the_view_until_the_next_change(spark, mirror):
    mirror.refresh_uc_metadata("cat")
    before = bag(mirror.view())
    mirror.colocate()
    kept = mirror.view()
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString() and bag(kept) == before
    mirror.colocate()  # replaces the first copies
    assert bag(mirror.view()) == before and len([f for f in mirror.unused_folders() if "/buckets/" in f]) == 2
    mirror.refresh_uc_metadata_tags()
    assert bag(kept) == before and bag(mirror.view()) != before
    assert len([f for f in mirror.unused_folders() if "/buckets/" in f]) == 4
