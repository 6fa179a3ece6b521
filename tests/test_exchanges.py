"""What stored tables and merges exchange: each row once for a purpose, and nothing to look up a layout."""

import re

import pytest
from pyspark.sql import functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.operators.keys import keyed
from metaloom.operators.merge import changed_rows
from metaloom.plans import queries
from metaloom.plans.partitions import PartitionedTable
from metaloom.plans.queries import _merge_inputs
from metaloom.session import stage, staging_path
from metaloom.workload import Workload
from tests.fixtures import bag, inventory

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_broadcast(conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)


def rows_of(spark, *rows):
    return keyed(inventory(spark, *rows))


def test_dealing_to_sub_parts_exchanges_nothing(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS exchanges")
    place = (spark, "spark_catalog", "exchanges", "dealt", schemas.METADATA, fv.CATALOG_ID)
    table = PartitionedTable(*place, staging_path(spark, "dealt"), parts=8, sub_by=fv.SCHEMA_ID)
    table.create()
    ids = spark.range(200).select(
        F.concat(F.lit("c"), F.col("id") % 20).alias(fv.CATALOG_ID), F.concat(F.lit("s"), "id").alias(fv.SCHEMA_ID)
    )
    subs = {0: 2, 1: 4, 2: 2, 5: 1024}
    dealt = table._dealt(ids, subs)
    assert not exchanges(dealt) and "Join" not in dealt._jdf.queryExecution().executedPlan().toString()
    layout = {(r.part, r.subs) for r in dealt.collect()}
    assert layout == {(part, subs.get(part, 1)) for part, _ in layout}
    assert all(0 <= r["sub"] < r.subs for r in dealt.collect()) and len({r["sub"] for r in dealt.collect()}) > 4


def test_changed_rows_are_joined_by_id_alone(spark):
    known = rows_of(spark, ("c", "s", "1", "cat", "sch", "a"), ("c", "s", "2", "cat", None, "b"))
    batch = rows_of(spark, ("c", "s", "1", "cat", "sch", "a"), ("c", "s", "2", "cat", None, "B"))
    changed = changed_rows(known, batch)
    assert len(exchanges(changed)) == 2 and all("," not in keys for keys in exchanges(changed))
    assert [r[fv.TABLE_NAME] for r in changed.collect()] == ["B"]
    assert not changed_rows(known, known).collect()


def test_the_metadata_is_that_of_all_applies(spark):
    w = Workload(spark, SF_DIR)
    assert bag(w.metadata()) == bag(w.applied())
    statuses = [r.o_orderstatus for r in w.table("orders").select("o_orderstatus").distinct().collect()]
    assert sum(w.metadata(F.col("o_orderstatus") == s).count() for s in statuses) == w.applied().count()


def test_the_metadata_exchanges_numbers(spark):
    known, _ = _merge_inputs(Workload(spark, SF_DIR))
    keys = exchanges(known)
    assert not any(fv.RECORD_ID in k or fv.TABLE_ID in k for k in keys), keys


def test_orders_without_lines_have_no_outcome(spark):
    w = Workload(spark, SF_DIR)
    w._read["lineitem"] = w.table("lineitem").filter("l_orderkey % 2 = 0")
    assert bag(w.metadata()) == bag(w.applied())
    unlogged = w.metadata("o_orderkey % 2 = 1")
    assert unlogged.count() == unlogged.filter(F.col(fv.SYNC_STATUS).isNull() & F.col(fv.SYNC_DATE).isNull()).count() > 0


def test_a_first_fill_stages_no_metadata(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(queries, "stage", lambda rows, name: (staged.append(name), stage(rows, name))[1])
    w = Workload(spark, SF_DIR)
    mirror = queries._filled_mirror(w)
    assert "metadata" not in staged
    assert bag(mirror.metadata.read()) == bag(w.metadata()) and bag(mirror.tags.read()) == bag(w.tags())


def test_a_first_fill_stages_no_tags_and_exchanges_no_texts(spark, monkeypatch):
    staged, short = [], []
    monkeypatch.setattr(queries, "stage", lambda rows, name: (staged.append(name), stage(rows, name))[1])
    for made in ("metadata_of", "tags_of"):
        method = getattr(Workload, made)
        monkeypatch.setattr(
            Workload, made, lambda w, rows, *more, method=method: (short.append(rows), method(w, rows, *more))[1]
        )
    queries._filled_mirror(Workload(spark, SF_DIR))
    assert "tags" not in staged and len(short) == 2
    for rows in short:  # what texts are made of has been dealt already
        assert "RebalancePartitions" in rows._jdf.queryExecution().optimizedPlan().toString()
        assert not {fv.TABLE_LOCATION, fv.SYNC_MESSAGE, "table_name", "tag_name"} & set(rows.columns)


def test_partitions_with_rows_are_not_filled(spark):
    w = Workload(spark, SF_DIR)
    mirror = queries._filled_mirror(w)
    before = bag(mirror.tags.read())
    tables = w.inventory().withColumnsRenamed(dict(zip(schemas.SOURCE_NAMES, schemas.TAG_KEYS)))
    with pytest.raises(ValueError, match="has rows already"):
        mirror.tags.fill(tables, w.short_tags(), lambda short: w.tags_of(short, "part", "subs", "sub"))
    assert bag(mirror.tags.read()) == before


def test_touching_rows_are_computed_once(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS exchanges")
    place = (spark, "spark_catalog", "exchanges", "touched", schemas.METADATA, fv.CATALOG_ID)
    table = PartitionedTable(*place, staging_path(spark, "touched"), parts=8, sub_by=fv.SCHEMA_ID, sub_rows=10)
    table.create()
    seen = spark.sparkContext.accumulator(0)

    def tell(rows):
        for batch in rows:
            seen.add(len(batch))
            yield batch

    ids = spark.range(200).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias(fv.CATALOG_ID), F.concat(F.lit("s"), "id").alias(fv.SCHEMA_ID)
    )
    places = table.touched(ids.mapInPandas(tell, ids.schema))
    assert seen.value == 200
    subs = {part: n for part, n, _ in places if n > 1}
    assert subs and {tuple(r) for r in table._dealt(ids, subs).select("part", "subs", "sub").collect()} == places
    larger = {n for _, n, _ in table.touched(ids, rows_each=4)}
    assert max(larger) == 4 * max(subs.values())


def test_the_stored_view_exchanges_each_row_once_without_a_hash(spark):
    mirror = queries._filled_mirror(Workload(spark, SF_DIR))
    keys = exchanges(spark.table(mirror.view_name))
    assert len(keys) == 2 and sum(k.startswith("xxhash64(") for k in keys) == 1


def test_lines_with_odd_flags_have_the_outcome_of_all_others(spark):
    w = Workload(spark, SF_DIR)
    n = F.col("l_orderkey") + F.col("l_linenumber")
    w._read["lineitem"] = w.table("lineitem").withColumns(
        {
            "l_returnflag": F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, "X").otherwise(F.col("l_returnflag")),
            "l_linestatus": F.when(n % 3 == 0, F.lit(None)).when(n % 7 == 1, "Z").otherwise(F.col("l_linestatus")),
            "l_quantity": F.when(n % 11 == 0, F.lit(None)).otherwise(F.col("l_quantity")),
        }
    )
    assert bag(w.metadata()) == bag(w.applied())
