import pytest

from metaloom import fixed_values as fv, schemas
from metaloom.operators import targets
from metaloom.operators.tags import (
    default_tags,
    pivot_tags,
    set_default_tags,
    set_tags,
    untagged_tables,
)
from metaloom.operators.view import enriched_view, register_view
from tests.fixtures import bag, by, metadata, named, tags

T = ("cat", "sch", "tab")
DB, SC, TB, FLAG, VOL = schemas.TAG_NAMES


def mapping(name, flag="true", volume=""):
    key = ("cat", "sch", name)
    return [
        (*key, DB, "db"),
        (*key, SC, "sc"),
        (*key, TB, name),
        (*key, FLAG, flag),
        (*key, VOL, volume),
    ]


class TestPivot:
    def test_one_column_per_tag(self, spark):
        assert pivot_tags(tags(spark, *mapping("tab"))).first().asDict() == {
            "catalog_name": "cat",
            "schema_name": "sch",
            "table_name": "tab",
            DB: "db",
            SC: "sc",
            TB: "tab",
            FLAG: "true",
            VOL: "",
        }

    def test_copies_resolve_to_the_largest_value(self, spark):
        row = pivot_tags(tags(spark, (*T, DB, "a"), (*T, DB, "b"), (*T, DB, "B"), (*T, SC, None))).first()
        assert (row[DB], row[SC]) == ("b", None)

    def test_other_tags_add_no_row(self, spark):
        assert pivot_tags(tags(spark, (*T, "owner", "me"))).count() == 0


class TestView:
    def test_every_record_once(self, spark):
        meta = metadata(spark, named(1, *T), named(2, "cat", "sch", "bare"))
        view = by(enriched_view(meta, tags(spark, *mapping("tab"), (*T, "owner", "me"))), fv.RECORD_ID)
        assert set(view) == {1, 2}
        assert view[1][DB] == "db" and view[2][DB] is None
        assert list(view[1]) == schemas.VIEW.names

    def test_types(self, spark):
        view = enriched_view(metadata(spark, named(1, *T)), tags(spark))
        assert view.schema.simpleString() == schemas.VIEW.simpleString()

    def test_names_match_exactly(self, spark):
        meta = metadata(
            spark, named(1, "CAT", "sch", "tab"), named(2, None, "sch", "tab"), named(3, *T), named(4, *T)
        )
        rows = [(*T, DB, "db"), (None, "sch", "tab", DB, "null")]
        view = by(enriched_view(meta, tags(spark, *rows)), fv.RECORD_ID)
        assert {i: r[DB] for i, r in view.items()} == {1: None, 2: None, 3: "db", 4: "db"}

    def test_link_of_synced_records(self, spark):
        synced = {fv.ACCOUNT: "Org-A", fv.SYNC_STATUS: "success"}
        meta = metadata(spark, named(1, *T, **synced), named(2, "cat", "sch", "bare", **synced))
        view = by(enriched_view(meta, tags(spark, *mapping("tab"))), fv.RECORD_ID)
        assert view[1][fv.LINK].endswith("/org/a/#/data/databases/DB/schemas/SC/table/TAB")
        assert view[2][fv.LINK] is None

    def test_sql(self, spark):
        register_view(enriched_view(metadata(spark, named(1, *T)), tags(spark, *mapping("tab"))), "some_vw")
        assert spark.sql(f"SELECT {DB} FROM some_vw").first()[0] == "db"
        register_view(enriched_view(metadata(spark), tags(spark)), "some_vw")
        assert spark.table("some_vw").count() == 0


class TestUntagged:
    def view(self, spark, *tag_rows):
        return enriched_view(metadata(spark, named(1, *T)), tags(spark, *tag_rows))

    def test_columns(self, spark):
        found = untagged_tables(self.view(spark))
        assert found.columns == [*schemas.SOURCE_NAMES, fv.RECORD_ID]
        assert bag(found) == [(*T, 1)]

    @pytest.mark.parametrize("name", [DB, SC, TB, FLAG])
    def test_one_mapping_tag_is_enough(self, spark, name):
        assert untagged_tables(self.view(spark, (*T, name, "x"))).count() == 0

    @pytest.mark.parametrize("name, value", [(VOL, "x"), ("owner", "x"), (DB, None)])
    def test_others_are_not(self, spark, name, value):
        assert untagged_tables(self.view(spark, (*T, name, value))).count() == 1


class TestDefaultTags:
    DEFAULTS = sorted([(*T, DB, "cat"), (*T, SC, "sch"), (*T, TB, "tab"), (*T, VOL, ""), (*T, FLAG, "true")])

    def after(self, spark, meta, tag_table):
        new = default_tags(untagged_tables(enriched_view(meta, tag_table)))
        return set_default_tags(tag_table, new)

    def test_rows(self, spark):
        view = enriched_view(metadata(spark, named(1, *T), named(2, *T)), tags(spark))
        assert bag(default_tags(untagged_tables(view))) == self.DEFAULTS

    def test_replaces_and_keeps(self, spark):
        meta = metadata(spark, named(1, *T), named(2, "cat", "sch", "part"))
        kept = [(*T, "owner", "me"), ("cat", "sch", "part", VOL, "v"), ("cat", "sch", "part", DB, "x"),
                ("gone", "g", "g", VOL, "v"), ("gone", "g", "g", SC, None)]
        replaced = [(*T, VOL, "old"), (*T, VOL, "older"), (*T, DB, None)]
        after = self.after(spark, meta, tags(spark, *kept, *replaced))
        assert bag(after) == bag(tags(spark, *kept, *self.DEFAULTS))

    def test_same_as_setting_tags_in_general(self, spark):
        meta = metadata(spark, named(1, *T))
        table = tags(spark, (*T, VOL, "old"), (*T, "owner", "me"), ("c", "s", "t", DB, "x"))
        new = default_tags(untagged_tables(enriched_view(meta, table)))
        assert bag(set_default_tags(table, new)) == bag(set_tags(table, new))

    def test_nothing_is_untagged_afterwards(self, spark):
        meta = metadata(spark, named(1, *T), named(2, "a", "b", "c"))
        after = self.after(spark, meta, tags(spark, (*T, VOL, "v")))
        assert untagged_tables(enriched_view(meta, after)).count() == 0
        assert bag(self.after(spark, meta, after)) == bag(after)


class TestTargets:
    def view(self, spark, flags, **more):
        rows = [named(i, "cat", "sch", f"t{i}", **{fv.INTEGRATION: "int", **more}) for i, _ in enumerate(flags)]
        tag_rows = [r for i, f in enumerate(flags) for r in mapping(f"t{i}", f) if r[4] is not None]
        return enriched_view(metadata(spark, *rows), tags(spark, *tag_rows))

    def test_flag(self, spark):
        flags = ["true", "TRUE", "yes", "1", "false", "maybe", "", None]
        found = targets.eligible_tables(self.view(spark, flags))
        assert bag(found, fv.TABLE_NAME) == [("t0",), ("t1",), ("t2",), ("t3",)]
        assert bag(found) == bag(targets.eligible_tables(self.view(spark, flags), unique_records=True))

    def test_volume_is_carried(self, spark):
        assert fv.EXTERNAL_VOLUME in targets.eligible_tables(self.view(spark, ["true"])).columns

    @pytest.mark.parametrize("missing", [fv.INTEGRATION, fv.TABLE_NAME, DB, SC, TB])
    def test_complete_only(self, spark, missing):
        from pyspark.sql import functions as F

        view = self.view(spark, ["true"])
        assert targets.eligible_tables(view).count() == 1
        view = view.withColumn(missing, F.lit(None).cast("string"))
        assert targets.eligible_tables(view).count() == 0

    def test_whole_row_copies_are_one(self, spark):
        view = self.view(spark, ["true"])
        assert targets.eligible_tables(view.union(view)).count() == 1

    def test_integrations_need_no_tag(self, spark):
        meta = metadata(
            spark,
            named(1, "cat", "sch", "a", **{fv.INTEGRATION: "int"}),
            named(2, "cat", "sch", "b", **{fv.INTEGRATION: "int"}),
            named(3, "cat", "zch", "a", **{fv.INTEGRATION: "int2"}),
            named(4, "cat", None, "a", **{fv.INTEGRATION: "int3"}),
            named(5, "cat", "nul", "a"),
        )
        found = targets.integration_targets(enriched_view(meta, tags(spark)))
        assert bag(found) == [("int", "cat", "sch"), ("int2", "cat", "zch")]

    def test_databases_and_schemas(self, spark):
        tables = targets.eligible_tables(self.view(spark, ["true", "true", "false"]))
        assert bag(targets.target_databases(tables)) == [("db",)]
        assert bag(targets.target_schemas(tables)) == [("db", "sc")]
