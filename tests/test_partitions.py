import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.operators.keys import keyed
from metaloom.operators.merge import upsert_metadata
from metaloom.plans.partitions import PartitionedTable
from metaloom.session import staging_path
from metaloom.sources.tables import read_metadata, read_table, read_tags
from tests.fixtures import bag, inventory, tags


@pytest.fixture
def table(spark):
    created = PartitionedTable(
        spark,
        "spark_catalog",
        "default",
        f"t_{uuid.uuid4().hex}",
        schemas.METADATA,
        fv.CATALOG_ID,
        staging_path(spark, "tables"),
        "it's a comment",
        parts=16,
    )
    created.create()
    return created


def catalogs(spark, *names, mark=""):
    return keyed(inventory(spark, *((n, "s", i, n, "sch", f"{mark}{i}") for n in names for i in "12")))


def merge(table, batch):
    return table.rewrite(batch, lambda known: upsert_metadata(known, batch))


def test_create_is_idempotent(spark, table):
    table.create()
    assert table.read().schema.simpleString() == schemas.METADATA.simpleString()
    assert table.read().count() == 0 and table.folders() == {}
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table.name}").collect()}
    assert details["Comment"] == "it's a comment"


def test_content_may_derive_from_the_table(spark, table):
    rows = catalogs(spark, *"abcdef")
    assert merge(table, rows) == []
    assert bag(table.read()) == bag(rows)
    assert bag(read_metadata(spark, table.name)) == bag(rows)
    renamed = catalogs(spark, *"abcdef", mark="new")
    replaced = merge(table, renamed)
    assert bag(table.read()) == bag(renamed)
    assert len(replaced) == len(table.folders()) and not set(replaced) & set(table.folders().values())


def test_untouched_partitions_stay(spark, table):
    merge(table, catalogs(spark, *"abcdef"))
    before = table.folders()
    merge(table, catalogs(spark, "a", mark="new"))
    after = table.folders()
    changed = [p for p in after if after[p] != before[p]]
    assert set(after) == set(before) and len(changed) == 1
    names = bag(table.read(), fv.CATALOG_NAME, fv.TABLE_NAME)
    assert ("a", "new1") in names and ("b", "1") in names and len(names) == 12


def test_only_touched_partitions_are_read(spark, table):
    merge(table, catalogs(spark, *"abcdef"))
    seen = []

    def change(known):
        seen.append(known)
        return known

    table.rewrite(catalogs(spark, "a"), change)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "InMemoryFileIndex(1 paths)" in plan


def test_nothing_touched(spark, table):
    merge(table, catalogs(spark, "a"))
    before = table.folders()
    assert merge(table, catalogs(spark)) == []
    assert table.folders() == before


def test_a_failed_change_changes_nothing(spark, table):
    merge(table, catalogs(spark, "a"))
    before = table.folders()
    twice = catalogs(spark, "a").union(catalogs(spark, "a"))
    with pytest.raises(PySparkException):
        merge(table, twice)
    assert table.folders() == before and table.read().count() == 2


def test_old_files_outlive_the_change(spark, table):
    merge(table, catalogs(spark, "a"))
    (folder,) = table.folders().values()
    assert merge(table, catalogs(spark, "a", mark="new")) == [folder]
    assert spark.read.parquet(folder).count() == 2


def test_paths_and_names_read_alike(spark):
    path = staging_path(spark, "tags")
    rows = tags(spark, ("c", "s", "t", "n", "v"))
    rows.withColumn("more", F.lit(1)).write.parquet(path)
    assert bag(read_tags(spark, path)) == bag(rows)
    rows.createOrReplaceTempView("some_tags")
    assert bag(read_table(spark, "some_tags")) == bag(rows)


@pytest.fixture
def subbed(spark):
    """A third of all rows is one catalog of 64 schemas, dealt to sub-parts of about 32 rows."""
    created = PartitionedTable(
        spark,
        "spark_catalog",
        "default",
        f"t_{uuid.uuid4().hex}",
        schemas.METADATA,
        fv.CATALOG_ID,
        staging_path(spark, "tables"),
        parts=16,
        sub_by=fv.SCHEMA_ID,
        sub_rows=32,
    )
    created.create()
    small = [(f"c{c}", "s", str(i), f"c{c}", "s", f"t{i}") for c in range(8) for i in range(128)]
    merge(created, keyed(inventory(spark, *large(), *small)))
    return created


def large(mark="", only=range(64)):
    return [("big", f"s{s}", f"{s}-{i}", "big", f"s{s}", f"{mark}{i}") for s in only for i in range(8)]


def rows_in(spark, folders):
    return sum(spark.read.parquet(f).count() for f in folders)


def test_a_schema_of_a_large_catalog_is_a_small_change(spark, subbed):
    before, everything = subbed.folders(), bag(subbed.read(), fv.CATALOG_ID, fv.SCHEMA_ID, fv.TABLE_ID)
    big = {place for place in before if place[1] > 1}
    assert len({p[0] for p in big}) >= 1 and sum(p[1] == 16 for p in big) == 16
    replaced = merge(subbed, keyed(inventory(spark, *large("new", [5]))))
    after = subbed.folders()
    assert len(replaced) == 1 and rows_in(spark, replaced) < 512 / 10
    assert [p for p in after if after[p] != before[p]] == [p for p in before if before[p] in replaced]
    assert bag(subbed.read(), fv.CATALOG_ID, fv.SCHEMA_ID, fv.TABLE_ID) == everything
    new = subbed.read().filter(F.col(fv.TABLE_NAME).startswith("new"))
    assert bag(new, fv.SCHEMA_ID) == [("s5",)] * 8


def test_another_object_deals_alike(spark, subbed):
    again = PartitionedTable(
        spark, subbed.catalog, subbed.schema, subbed.table, subbed.columns, subbed.part_by, subbed.location,
        parts=3, sub_by=fv.SCHEMA_ID, sub_rows=1_000_000,
    )
    merge(again, keyed(inventory(spark, *large("new"))))
    assert again.partitions() == subbed.partitions() and again.read().count() == 1536
    assert again.read().filter(F.col(fv.TABLE_NAME).startswith("new")).count() == 512


def test_only_the_touched_sub_part_is_read(spark, subbed):
    seen = []
    subbed.rewrite(keyed(inventory(spark, *large("new", [7]))), lambda known: seen.append(known) or known)
    assert "InMemoryFileIndex(1 paths)" in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_outgrown_parts_are_dealt_anew(spark, subbed):
    rows = bag(subbed.read())
    assert subbed.redeal() == []
    subbed.sub_rows = 4
    replaced = subbed.redeal()
    assert bag(subbed.read()) == rows and len(replaced) > 1
    assert max(p[1] for p in subbed.partitions()) == 128
    merge(subbed, keyed(inventory(spark, *large("new"))))
    assert subbed.read().count() == len(rows)


class Stopped(Exception):
    pass


def test_a_stopped_switch_is_finished(spark, table, monkeypatch):
    merge(table, catalogs(spark, *"abcdef"))
    before, renamed = table.folders(), catalogs(spark, *"abcdef", mark="new")
    assert len(before) >= 3
    places = sorted(before)

    def point(self, place, folder):
        if place != places[0]:
            raise Stopped
        return PartitionedTable._point(self, place, folder)

    class Stopping(PartitionedTable):
        _point = point

    stopping = Stopping(*(getattr(table, n) for n in ("spark", "catalog", "schema", "table", "columns", "part_by", "location")))
    with pytest.raises(Stopped):
        merge(stopping, renamed)
    half = table.folders()
    assert [p for p in places if half[p] != before[p]] == places[:1]
    table.create()
    assert bag(table.read()) == bag(renamed) and set(table.unused) == {before[p] for p in places[1:]}
    assert table.finish() == []


def test_a_stopped_switch_is_finished_before_the_next_change(spark, table, monkeypatch):
    merge(table, catalogs(spark, *"abc"))
    with monkeypatch.context() as patch:
        patch.setattr(PartitionedTable, "finish", lambda self: [])
        merge(table, catalogs(spark, *"abcx", mark="one"))
    assert table.read().count() == 6
    merge(table, catalogs(spark, "a", mark="two"))
    assert bag(table.read()) == bag(catalogs(spark, "b", "c", "x", mark="one").union(catalogs(spark, "a", mark="two")))


def test_emptied_partitions_go(spark, table):
    merge(table, catalogs(spark, *"abc"))
    table.rewrite(catalogs(spark, "a"), lambda known: known.filter(F.col(fv.CATALOG_ID) != "a"))
    assert table.read().count() == 4
