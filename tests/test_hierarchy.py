from collections import Counter

import pytest
from pyspark.sql import functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.operators.hierarchy import flatten, nest
from metaloom.operators.paging import list_pages, paged_lists
from tests.fixtures import bag, inventory


@pytest.fixture
def rows(spark):
    """One schema with most tables, a small one, and another catalog."""
    return inventory(
        spark,
        *(("c", "hot", f"h{i}", "cat", "hot", f"t{i}") for i in range(300)),
        *(("c", "small", f"s{i}", "cat", "small", f"t{i}") for i in range(3)),
        ("d", "one", "x", "dog", "one", "x"),
    )


@pytest.fixture
def names(spark, rows):
    columns = [fv.CATALOG_ID, fv.CATALOG_NAME, fv.SCHEMA_ID, fv.SCHEMA_NAME]
    empty = spark.createDataFrame(
        [("c", "cat", "void", "void"), ("e", "emu", "none", "none")], ", ".join(f"{c} string" for c in columns)
    )
    return rows.select(*columns).distinct().unionByName(empty)


@pytest.mark.parametrize("page_size", [1, 7, 1000])
def test_flatten_inverts_nest(rows, names, page_size):
    assert bag(flatten(nest(rows, names, page_size=page_size))) == bag(rows)


def test_shape(rows, names):
    nested = nest(rows, names)
    assert nested.schema.simpleString() == schemas.CATALOG_NODE.simpleString()


def test_small_catalog_is_one_row(rows, names):
    nested = {r.uc_name: r for r in nest(rows, names).collect()}
    assert set(nested) == {"cat", "dog", "emu"}
    cat = nested["cat"]
    assert (cat.uc_id, cat.sf_name, cat.page) == ("c", "cat", 0)
    assert {s.uc_name: len(s.tables) for s in cat.schemas} == {"hot": 300, "small": 3, "void": 0}
    assert nested["emu"].schemas[0].tables == []


def test_empty_schemas_can_be_left_out(rows, names):
    found = {s.uc_name for r in nest(rows, names, include_empty_schemas=False).collect() for s in r.schemas}
    assert found == {"hot", "small", "one"}


def test_hot_schema_is_split(rows, names):
    nested = nest(rows, names, page_size=10)
    sizes = [len(s.tables) for r in nested.collect() for s in r.schemas if s.uc_name == "hot"]
    assert sum(sizes) == 300 and len(sizes) > 20 and max(sizes) <= 30
    weights = [sum(len(s.tables) for s in r.schemas) for r in nested.filter("uc_name = 'cat'").collect()]
    assert max(weights) <= 80
    empties = [s.uc_name for r in nested.collect() for s in r.schemas if not s.tables]
    assert sorted(empties) == ["none", "void"]


def test_paged_lists_hold_all_rows(spark):
    df = spark.range(500).select(F.when(F.col("id") < 450, "hot").otherwise("cold").alias("g"), "id")
    pages = paged_lists(df, ["g"], ["id"], "items", page_size=20).collect()
    assert Counter(i.id for p in pages for i in p["items"]) == Counter(range(500))
    assert max(len(p["items"]) for p in pages) <= 50
    assert sum(1 for p in pages if p.g == "hot") > 10


def test_list_pages(spark):
    df = spark.range(100).select("id", (F.col("id") * 2).alias("twice"))
    one = list_pages(df).collect()
    assert len(one) == 1 and sorted((i.id, i.twice) for i in one[0].combinations) == [(i, 2 * i) for i in range(100)]
    many = list_pages(df, page_size=10).collect()
    assert len(many) > 5 and sum(len(p.combinations) for p in many) == 100
    assert list_pages(df.filter("id < 0")).collect() == []
