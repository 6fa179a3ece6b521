from collections import Counter

import pytest

from metaloom.operators.apply import kind_of, read_ledger, run_durably, run_statements
from metaloom.session import stage
from tests.fixtures import by


def refusing():
    """A connection on which statements that name a bad object fail."""

    def execute(sql):
        if "bad" in sql:
            raise ValueError(f"no: {sql}")

    return execute


def statements(spark, n=20):
    rows = [(i, f"t{i}", f"CREATE {'bad' if i % 4 == 0 else 'good'}{i}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, object_name string, statement string")


def test_every_statement_has_one_outcome(spark):
    kind = lambda error: "compile" if isinstance(error, ValueError) else "other"
    done = stage(run_statements(statements(spark), refusing, error_kind=kind), "test")
    assert done.columns == ["id", "object_name", "error", "error_kind", "applied_at"]
    rows = by(done, "id")
    assert set(rows) == set(range(20))
    assert rows[0]["error"] == "no: CREATE bad0" and rows[0]["error_kind"] == "compile"
    assert rows[1]["error"] is None and rows[1]["error_kind"] is None
    assert all(r["applied_at"] is not None for r in rows.values())


def test_one_connection_per_partition(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        import tempfile

        tempfile.mkstemp(dir=folder)
        return lambda sql: None

    done = run_statements(statements(spark).repartition(7), connect, connections=3)
    assert done.rdd.getNumPartitions() == 3
    assert Counter(r.id for r in done.collect()) == Counter(range(20))
    assert 1 <= len(list(tmp_path.iterdir())) <= 3


def test_no_statements_no_connection(spark):
    def connect():
        raise RuntimeError("must not connect")

    assert run_statements(statements(spark, 0), connect).count() == 0


def test_kinds_of_errors():
    class ProgrammingError(Exception):
        pass

    assert kind_of(ValueError("Object 'x' already exists.")) == "conflict"
    assert kind_of(ProgrammingError("bad")) == kind_of(ValueError("SQL compilation error")) == "compile"
    assert kind_of(ValueError("timeout")) == "other"


def test_statements_of_one_file_are_spread(spark):
    one = statements(spark, 200).coalesce(1)
    assert run_statements(one, refusing, connections=6).rdd.getNumPartitions() == 6
    assert run_statements(one, refusing).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_secrets_are_filled_in_and_never_shown(spark):
    rows = [(1, "CREATE x '${A}'"), (2, "CREATE x '${B}'"), (3, "bad '${A}'")]
    todo = spark.createDataFrame(rows, "id long, statement string")

    def connect():
        def execute(sql):
            if "$" in sql or "it''s" not in sql:
                raise AssertionError("not filled")
            if "bad" in sql:
                raise ValueError(f"no: {sql}")

        return execute

    done = by(stage(run_statements(todo, connect, secrets=lambda: {"A": "it's"}), "test"), "id")
    assert done[1]["error"] is None and done[2]["error"] == "no secret for B"
    assert done[3]["error"] == "no: bad '${A}'"


def test_blank_statements_are_not_run(spark):
    rows = [(1, ""), (2, " \n\t"), (3, None), (4, "CREATE good")]
    done = run_statements(spark.createDataFrame(rows, "id long, statement string"), refusing)
    assert [r.id for r in done.collect()] == [4]


class Denied(Exception):
    sqlstate = "42710"


class ConflictError(Exception):
    pass


class ProgrammingError(Exception):
    pass


@pytest.mark.parametrize(
    "error, kind",
    [
        (ValueError("SQL compilation error: table CONFLICT_LOG not found"), "compile"),
        (ValueError("SQL compilation error: Database 'ALREADY EXISTS' does not exist"), "compile"),
        (ValueError("SQL compilation error:\nObject 'LAKE.CONFLICT' already exists."), "conflict"),
        (ProgrammingError("002002 (42710): 01b2-ab: SQL compilation error:\nObject 'it''s' already exists."), "conflict"),
        (ProgrammingError("002003 (02000): SQL compilation error: no schema"), "compile"),
        (ProgrammingError("anything"), "compile"),
        (ValueError("syntax error line 1 at position 7 unexpected 'x'"), "compile"),
        (ValueError("no access to table already exists"), "other"),
        (ValueError("lock conflict on CATALOG"), "other"),
        (Denied("nope"), "conflict"),
        (ConflictError("409"), "conflict"),
    ],
)
def test_kinds_do_not_depend_on_names(error, kind):
    assert kind_of(error) == kind


def ran(folder):
    return Counter(p.read_text() for p in folder.iterdir())


def noting(folder, stop_at=None, die=False):
    """A connection that notes each statement it has finished, and breaks at one."""
    folder = str(folder)

    def connect():
        import os
        import uuid

        def execute(sql):
            if sql == stop_at and not os.path.exists(f"{folder}-go"):
                if die:
                    os._exit(1)
                raise SystemExit("the line is dead")
            if "bad" in sql:
                raise ValueError("no")
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                file.write(sql)

        return execute

    return connect


@pytest.mark.parametrize("die", [False, True])
def test_outcomes_outlive_a_failed_run(spark, tmp_path, die):
    folder, ledger = tmp_path / "ran", str(tmp_path / "ledger")
    folder.mkdir()
    todo = statements(spark, 40)
    with pytest.raises(Exception):
        run_durably(todo, noting(folder, "CREATE good7", die), ledger, connections=2, per_task=4)
    first = ran(folder)
    kept = by(read_ledger(todo, ledger), "id")
    finished = {f"CREATE good{i}" for i in kept if i % 4}
    assert 7 not in kept and finished <= set(first)
    if not die:  # nothing that was finished is lost, in no task
        assert finished == set(first)
    (tmp_path / "ran-go").touch()
    done = run_durably(todo, noting(folder, "CREATE good7", die), ledger, connections=2, per_task=4)
    rows = by(done, "id")
    assert set(rows) == set(range(40)) and {i for i, r in rows.items() if r["error"]} == {i for i in range(40) if i % 4 == 0}
    again = {sql for sql, n in ran(folder).items() if n > 1}
    assert len(again) <= 7 and not again & finished and set(ran(folder)) == {f"CREATE good{i}" for i in range(40) if i % 4}
    before = ran(folder)
    assert by(run_durably(todo, noting(folder), ledger), "id") == rows and ran(folder) == before


def test_a_connection_that_fails_stops_the_run(spark, tmp_path):
    def connect():
        raise OSError("no route")

    with pytest.raises(RuntimeError, match="no route"):
        run_durably(statements(spark), connect, str(tmp_path / "ledger"))
    with pytest.raises(Exception, match="no route"):
        run_statements(statements(spark), connect).collect()


def test_equal_rows_are_one(spark, tmp_path):
    twice = statements(spark, 6).union(statements(spark, 6))
    assert run_durably(twice, refusing, str(tmp_path / "ledger")).count() == 6
    assert run_durably(twice.limit(0), refusing, str(tmp_path / "empty")).count() == 0
