import json

import pytest
from pyspark.sql import functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.operators import inventory as inv
from metaloom.sources import entities, listings
from metaloom.sources.tables import typed_rows
from tests.fixtures import UUID_A, bag


def schema_pages(spark, *bodies, catalog="cat"):
    return typed_rows(spark, [(catalog, b) for b in bodies], schemas.SCHEMA_PAGES)


def table_pages(spark, *pages):
    return typed_rows(spark, pages, schemas.TABLE_PAGES)


def listing(*names, token=None):
    identifiers = [{"namespace": ["s"], "name": n} for n in names]
    return json.dumps({"identifiers": identifiers, "next-page-token": token})


class TestSchemaPages:
    def test_all_pages_and_first_level(self, spark):
        pages = schema_pages(
            spark,
            '{"namespaces":[["sales"],["information_schema"],["empty"]],"next-page-token":"p2"}',
            '{"namespaces":[["sales","deep"],["more"]]}',
        )
        assert bag(listings.list_schemas(pages), "schema_name") == [
            ("empty",), ("information_schema",), ("more",), ("sales",),
        ]

    def test_unreadable_is_rejected_and_empty_is_not(self, spark):
        pages = schema_pages(
            spark, '{"namespaces":[]}', '{"error":{"code":404}}', "<html>", None
        )
        assert listings.list_schemas(pages).count() == 0
        assert bag(listings.rejected_schema_pages(pages), "reason") == [
            ("page is no listing: <html>",),
            ("page is no listing: NULL",),
            ('page is no listing: {"error":{"code":404}}',),
        ]


class TestTablePages:
    def test_all_pages(self, spark):
        pages = table_pages(
            spark,
            ("cat", "s", listing("a", "b", token="2")),
            ("cat", "s", listing("b", "c")),
            ("cat", "z", listing()),
        )
        assert bag(listings.list_tables(pages)) == [
            ("cat", "s", "a"), ("cat", "s", "b"), ("cat", "s", "c"),
        ]
        assert listings.rejected_table_pages(pages).count() == 0

    def test_rejects(self, spark):
        pages = table_pages(spark, ("cat", "s", "not json"), ("cat", "s", listing("a")))
        assert bag(listings.rejected_table_pages(pages)) == [
            ("cat", "s", None, "page is no listing: not json")
        ]


    @pytest.mark.parametrize(
        "body",
        [
            '{"identifiers":[{"name":"a"},',
            '{"identifiers":[{"name":"a"}],"next-page',
            '{"identifiers":[{"name":"a"}]} trailing',
            '{"identifiers":[{"name":"a"}]}{"identifiers":[{"name":"b"}]}',
            '{"identifiers":"a"}',
            '[{"identifiers":[{"name":"a"}]}]',
            "{}",
            "null",
            "",
            None,
        ],
    )
    def test_unreadable(self, spark, body):
        pages = table_pages(spark, ("cat", "s", body))
        assert listings.list_tables(pages).count() == 0
        assert bag(listings.rejected_table_pages(pages), "reason") == [
            (f"page is no listing: {'NULL' if body is None else body}",)
        ]

    def test_nameless_entries_are_reported(self, spark):
        body = '{"identifiers":[{"name":"a"},{"nam":"b"},null]}'
        pages = table_pages(spark, ("cat", "s", body), ("cat", "s", listing("c")))
        assert bag(listings.list_tables(pages), "table_name") == [("a",), ("c",)]
        assert bag(listings.rejected_table_pages(pages), "reason") == [
            (f"page has a nameless entry: {body}",)
        ]
        body = '{"namespaces":[["a"],[],null]}'
        pages = schema_pages(spark, body)
        assert bag(listings.list_schemas(pages), "schema_name") == [("a",)]
        assert bag(listings.rejected_schema_pages(pages), "reason") == [
            (f"page has a nameless entry: {body}",)
        ]


class TestLandedFiles:
    def test_names_are_text_and_bodies_whole(self, spark, tmp_path):
        folder = tmp_path / "tables" / "catalog_name=007" / "schema_name=a b"
        folder.mkdir(parents=True)
        (folder / "1.json").write_text(json.dumps({"identifiers": [{"name": "x"}]}, indent=2))
        (folder / "2.json").write_text("<html>\n</html>\n")
        pages = listings.read_table_pages(spark, str(tmp_path / "tables"))
        assert pages.columns == schemas.TABLE_PAGES.names
        assert bag(listings.list_tables(pages)) == [("007", "a b", "x")]
        assert bag(listings.rejected_table_pages(pages), "reason") == [
            ("page is no listing: <html>\n</html>\n",)
        ]

    def test_schema_pages(self, spark, tmp_path):
        folder = tmp_path / "catalog_name=cat"
        folder.mkdir()
        (folder / "1.json").write_text('{"namespaces": [["a"], ["b"]]}')
        pages = listings.read_schema_pages(spark, str(tmp_path))
        assert bag(listings.list_schemas(pages)) == [("cat", "a"), ("cat", "b")]


class TestWantedSchemas:
    @pytest.fixture
    def listed(self, spark):
        rows = [("cat", n) for n in ("information_schema", "a", "b")]
        return spark.createDataFrame(rows, "catalog_name string, schema_name string")

    def test_system_schemas_are_left_out(self, listed):
        assert bag(inv.wanted_schemas(listed), "schema_name") == [("a",), ("b",)]

    @pytest.mark.parametrize("include", ["a", ["a"], ["a", "none"]])
    def test_include_names(self, listed, include):
        assert bag(inv.wanted_schemas(listed, include), "schema_name") == [("a",)]

    def test_include_table(self, spark, listed):
        include = spark.createDataFrame([("b",), ("b",)], "schema_name string")
        wanted = inv.wanted_schemas(listed, include)
        assert wanted.columns == listed.columns and bag(wanted, "schema_name") == [("b",)]

    def test_include_may_name_a_system_schema(self, listed):
        wanted = inv.wanted_schemas(listed, ["information_schema"])
        assert bag(wanted, "schema_name") == [("information_schema",)]


class TestEntities:
    def test_copies_fold_and_conflicts_show(self, spark):
        df = typed_rows(
            spark,
            [("c", "s", "1"), ("c", "s", "1"), ("c", "z", "1"), ("c", "z", "2"), ("c", "n", None)],
            schemas.SCHEMA_ENTITIES,
        )
        rows = {r.schema_name: (r.schema_id, r.schema_conflict) for r in entities.schema_entities(df).collect()}
        assert rows["s"] == ("1", False) and rows["n"] == (None, False)
        assert rows["z"][1] is True


class TestLookUp:
    @pytest.fixture
    def facts(self, spark):
        catalogs = typed_rows(
            spark,
            [("cat", f"s3://b/{UUID_A}"), ("bare", "s3://b/none")],
            schemas.CATALOG_ENTITIES,
        )
        schema_table = typed_rows(
            spark, [("cat", "s", "s1"), ("cat", "noid", None), ("bare", "s", "s2")], schemas.SCHEMA_ENTITIES
        )
        good = ("MANAGED",)
        tables = typed_rows(
            spark,
            [
                ("cat", "s", "ok", "t1", "s3://t1", *good),
                ("cat", "s", "noid", None, "s3://t2", *good),
                ("cat", "s", "noloc", "t3", None, *good),
                ("cat", "s", "notype", "t4", "s3://t4", None),
                ("cat", "s", "twice", "t5", "s3://t5", *good),
                ("cat", "s", "twice", "t6", "s3://t5", *good),
                ("cat", "noid", "x", "t7", "s3://t7", *good),
                ("bare", "s", "x", "t8", "s3://t8", *good),
                ("cat", "s", "unlisted", "t9", "s3://t9", *good),
            ],
            schemas.TABLE_ENTITIES,
        )
        listed = tables.select(*schemas.TAG_KEYS).distinct().filter("table_name <> 'unlisted'")
        listed = listed.union(spark.createDataFrame([("cat", "s", "gone"), ("cat", "hidden", "x")], listed.schema))
        names = spark.createDataFrame(
            [("cat", "s"), ("cat", "noid"), ("bare", "s")], "catalog_name string, schema_name string"
        )
        return inv.look_up_tables(listed, names, catalogs, schema_table, tables)

    def test_inventory(self, facts):
        rows = inv.inventory(facts).collect()
        assert [r.asDict() for r in rows] == [
            {
                fv.CATALOG_ID: UUID_A,
                fv.SCHEMA_ID: "s1",
                fv.TABLE_ID: "t1",
                fv.CATALOG_NAME: "cat",
                fv.SCHEMA_NAME: "s",
                fv.TABLE_NAME: "ok",
                fv.TABLE_LOCATION: "s3://t1",
                fv.TABLE_TYPE: "MANAGED",
            }
        ]

    def test_rejects(self, facts):
        assert bag(inv.rejects(facts), "catalog_name", "schema_name", "table_name", "reason") == [
            ("bare", "s", "x", "catalog has no id"),
            ("cat", "noid", "x", "schema has no id"),
            ("cat", "s", "gone", "table has no id"),
            ("cat", "s", "noid", "table has no id"),
            ("cat", "s", "noloc", "table has no location"),
            ("cat", "s", "notype", "table has no type"),
            ("cat", "s", "twice", "table entities disagree"),
        ]

    def test_every_listed_table_is_kept_or_rejected(self, facts):
        assert inv.inventory(facts).count() + inv.rejects(facts).count() == facts.count()


def test_tables_per_schema(spark):
    names = spark.createDataFrame(
        [("c", "cat", "s", "full"), ("c", "cat", "e", "empty")],
        f"{fv.CATALOG_ID} string, {fv.CATALOG_NAME} string, {fv.SCHEMA_ID} string, {fv.SCHEMA_NAME} string",
    )
    from tests.fixtures import inventory

    rows = inventory(spark, ("c", "s", "1", "cat", "full", "a"), ("c", "s", "2", "cat", "full", "b"))
    counts = inv.tables_per_schema(names, rows)
    assert bag(counts, fv.SCHEMA_NAME, "n_tables") == [("empty", 0), ("full", 2)]
    assert bag(counts.filter(F.col("n_tables") > 0), fv.SCHEMA_NAME) == [("full",)]


TOKEN_PAGES = "catalog_name string, page_token string, body string"


def chain(spark, *pages, catalog="cat"):
    """Pages of (own token, next token)."""
    rows = [(catalog, own, json.dumps({"namespaces": [[f"s{own}"]], "next-page-token": following})) for own, following in pages]
    return spark.createDataFrame(rows, TOKEN_PAGES)


def breaks(pages):
    return [r.reason.removeprefix("listing: ") for r in listings.broken_schema_listings(pages).orderBy("reason").collect()]


class TestChains:
    @pytest.mark.parametrize(
        "pages, want",
        [
            ([(None, None)], []),
            ([(None, "b"), ("b", "c"), ("c", None)], []),
            ([(None, "b"), (None, "b"), ("b", "")], []),
            ([(None, "b"), ("c", None)], ["no page leads to page c", "page b is missing"]),
            ([("b", None)], ["no page leads to page b", "the first page is missing"]),
            ([(None, "b"), ("b", "b")], ["page b leads back to itself", "several pages lead to page b"]),
            ([(None, None), ("b", "c"), ("c", "d"), ("d", "b")], [f"page {x} leads back to itself" for x in "bcd"]),
            ([(None, "b"), (None, "c"), ("b", None), ("c", None)], ["the first page leads to several pages"]),
            ([(None, "b"), ("b", "d"), ("c", "d"), ("d", None)], ["no page leads to page c", "several pages lead to page d"]),
        ],
    )
    def test_what_breaks_them(self, spark, pages, want):
        assert breaks(chain(spark, *pages)) == want

    def test_long_chains_end_and_long_cycles_do_not(self, spark):
        chained = [(str(i) if i else None, str(i + 1) if i < 99 else None) for i in range(100)]
        cycle = [(f"c{i}", f"c{(i + 1) % 37}") for i in range(37)]
        assert breaks(chain(spark, *chained)) == []
        found = breaks(chain(spark, *chained, *cycle).union(chain(spark, *chained[:50], catalog="dog")))
        assert sorted(found) == sorted([*(f"page c{i} leads back to itself" for i in range(37)), "page 50 is missing"])

    def test_unreadable_pages_and_no_pages(self, spark):
        odd = [("cat", None, None), ("cat", "b", "<html>"), ("dog", None, '{"namespaces":[],"next-page-token":"x"}')]
        assert breaks(spark.createDataFrame(odd, TOKEN_PAGES)) == ["no page leads to page b", "page x is missing"]
        assert breaks(spark.createDataFrame([], TOKEN_PAGES)) == []

    def test_table_listings_are_chains_of_their_schema(self, spark):
        rows = [("cat", "s", None, listing("a", token="2")), ("cat", "t", "2", listing("b"))]
        rows = spark.createDataFrame(rows, "catalog_name string, schema_name string, page_token string, body string")
        assert bag(listings.broken_table_listings(rows), "schema_name", "reason") == [
            ("s", "listing: page 2 is missing"),
            ("t", "listing: no page leads to page 2"),
            ("t", "listing: the first page is missing"),
        ]

    def test_file_names_are_tokens(self, spark, tmp_path):
        folder = tmp_path / "catalog_name=cat"
        folder.mkdir()
        (folder / "first.json").write_text('{"namespaces":[["a"]],"next-page-token":"p/2 x"}')
        (folder / "p%2F2%20x.json").write_text('{"namespaces":[["b"]]}')
        pages = listings.read_schema_pages(spark, str(tmp_path), tokens=True)
        assert bag(pages, "catalog_name", listings.PAGE_TOKEN) == [("cat", None), ("cat", "p/2 x")]
        assert breaks(pages) == [] and listings.list_schemas(pages).count() == 2
        assert listings.PAGE_TOKEN not in listings.read_schema_pages(spark, str(tmp_path)).columns
