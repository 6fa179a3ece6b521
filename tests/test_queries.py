"""Every registered query against its SQL, over the smallest tables."""

import os
import sys

import pytest

import __spark_entry__ as entry
from metaloom.oracle import ORACLE
from metaloom.plans.queries import registered
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, tables, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, tables, entry.oracle_sql()[name]) is None


def test_entry(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema and first.count() > 0


@pytest.mark.parametrize("missing", ["metaloom.llm", "metaloom.llm.queries", "corpus_pipeline"])
def test_the_core_needs_nothing_optional(monkeypatch, missing):
    monkeypatch.setitem(sys.modules, missing, None)
    if missing == "metaloom.llm":
        monkeypatch.setitem(sys.modules, "metaloom.llm.queries", None)
    with pytest.warns(UserWarning, match="without"):
        left = entry.queries()
    assert set(registered()) <= set(left) and "pipeline" not in left
    with pytest.warns(UserWarning):
        assert set(ORACLE) <= set(entry.oracle_sql())
