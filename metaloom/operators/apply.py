"""Running statements from executors."""

from __future__ import annotations

import re
import math
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql import types as T

from metaloom.operators.joins import skew_safe_join
from metaloom.operators.statements import not_blank
from metaloom.session import stage, staging_path

Execute = Callable[[str], object]

#: Kind of an outcome that is none: what kept a statement, and those after it, from being finished.
STOPPED = "stopped"
#: Names a statement row in a ledger, and the run that its outcome is of.
STATEMENT_ID, ATTEMPT = "statement_id", "attempt"
#: Statements of a task. Outcomes are kept when a task ends, so a lost executor costs as many outcomes at most.
PER_TASK = 50

#: Stands in a statement for a secret of that name.
PLACEHOLDER = re.compile(r"\$\{([A-Z][A-Z_]*)\}")


#: How a warehouse says that an object is there, and the SQLSTATEs that say so.
EXISTS = re.compile(
    r"(?:\d+ \(\w{5}\): (?:[\w-]+: )?)?(?:sql compilation error:\s*)?object '(?:[^']|'')*' already exists\.?\s*", re.I
)
EXISTS_STATES = ("42710", "42P04", "42P06", "42P07")
CONFLICT_CLASSES = ("conflict", "conflicterror", "alreadyexists", "alreadyexistsexception", "alreadyexistserror")


def kind_of(error: Exception) -> str:
    """``conflict``, ``compile`` or ``other``, from what a connection raised.

    A conflict is told by the exception's class, its SQLSTATE or the warehouse's exact phrase; words within a longer
    text, such as an object's name, tell nothing.
    """
    name, text = type(error).__name__.lower(), str(error)
    if name in CONFLICT_CLASSES or getattr(error, "sqlstate", None) in EXISTS_STATES or EXISTS.fullmatch(text):
        return "conflict"
    compilation = re.match(r"(?:\d+ \(\w{5}\): (?:[\w-]+: )?)?(?:sql compilation error|syntax error)", text, re.I)
    if compilation or any(x in name for x in ("programming", "syntax", "parse")):
        return "compile"
    return "other"


def run_statements(
    statements: DataFrame,
    connect: Callable[[], Execute],
    connections: int | None = None,
    error_kind: Callable[[Exception], str] = kind_of,
    secrets: Callable[[], dict[str, str]] = dict,
    stop: bool = False,
) -> DataFrame:
    """Run each row's ``statement``; the other columns come back with ``error``,
    ``error_kind`` and ``applied_at``.

    ``connect`` is called once per partition, on the executor, and returns a function that
    runs one statement and raises on failure. ``secrets`` is called there too and returns what to put for each
    ``${NAME}``; a statement with a name that has none is not run but fails, and errors do not show secrets.
    ``connections`` is how many partitions there are, and so the load on the other side; the session's default
    parallelism if not given. Statements are dealt by hash, however few files they come from.
    ``error_kind`` names an exception's kind: ``compile``, ``conflict`` or ``other``.

    Stage the result before using it: each evaluation runs the statements. A retried task
    repeats its statements, which must therefore be safe to repeat. Blank statements are not run and give no row.

    What goes wrong outside of a statement, in ``connect``, ``secrets`` or by anything but an ``Exception``, fails the
    job. With ``stop`` it ends the partition instead: the statement it met comes back as of the kind ``STOPPED``,
    those after it do not come back, and those before it do.
    """
    statements = not_blank(statements)
    connections = connections or statements.sparkSession.sparkContext.defaultParallelism
    statements = statements.repartition(connections, F.xxhash64("statement"))
    kept = [f for f in statements.schema.fields if f.name != "statement"]
    result = T.StructType(
        [
            *kept,
            T.StructField("error", T.StringType()),
            T.StructField("error_kind", T.StringType()),
            T.StructField("applied_at", T.TimestampType()),
        ]
    )

    def filled(sql: str, known: dict[str, str]) -> str:
        missing = set(PLACEHOLDER.findall(sql)) - set(known)
        if missing:
            raise LookupError(f"no secret for {', '.join(sorted(missing))}")
        return PLACEHOLDER.sub(lambda m: known[m[1]].replace("'", "''"), sql)

    def shown(failure: BaseException, known: dict[str, str]) -> str:
        text = str(failure) or type(failure).__name__
        for name, secret in known.items():
            for form in {secret, secret.replace("'", "''")} - {""}:
                text = text.replace(form, f"${{{name}}}")
        return text

    def attempt(execute: Execute, sql: str, known: dict[str, str]) -> tuple[str | None, str | None, pd.Timestamp]:
        try:
            execute(filled(sql, known))
            error, kind = None, None
        except Exception as failure:  # every failure is a row, as the next must still run
            error, kind = shown(failure, known), error_kind(failure)
        return error, kind, pd.Timestamp.now(tz="UTC")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        execute, known = None, {}
        for batch in batches:
            done = []
            try:
                if execute is None and len(batch):
                    execute, known = connect(), secrets()
                for sql in batch["statement"]:
                    done.append(attempt(execute, sql, known))
            except BaseException as failure:
                if not stop:
                    raise
                done.append((shown(failure, known), STOPPED, pd.Timestamp.now(tz="UTC")))
            outcome = pd.DataFrame(done, columns=["error", "error_kind", "applied_at"])
            own = batch.drop(columns="statement").reset_index(drop=True)[: len(done)]
            yield pd.concat([own, outcome], axis=1)
            if done and done[-1][1] == STOPPED:
                return

    return statements.mapInPandas(run, result)


def _ledger_schema(like: DataFrame) -> T.StructType:
    kept = [f for f in like.schema.fields if f.name not in ("statement", STATEMENT_ID)]
    more = [T.StructField(n, T.StringType()) for n in ("error", "error_kind")]
    return T.StructType(
        [T.StructField(STATEMENT_ID, T.StringType()), *kept, *more, T.StructField("applied_at", T.TimestampType())]
    )


def read_ledger(like: DataFrame, ledger: str) -> DataFrame:
    """The newest outcome of every finished statement row of a ledger, in the columns of ``like`` (``statement`` apart)."""
    spark, own = like.sparkSession, _ledger_schema(like)
    try:
        rows = spark.read.schema(own).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], own)
    rest = F.struct(*(c for c in own.names if c != STATEMENT_ID))
    finished = rows.filter(~F.col("error_kind").eqNullSafe(STOPPED)).groupBy(STATEMENT_ID)
    return finished.agg(F.max_by(rest, "applied_at").alias("newest")).select(STATEMENT_ID, "newest.*")


def run_durably(
    statements: DataFrame,
    connect: Callable[[], Execute],
    ledger: str,
    connections: int | None = None,
    per_task: int = PER_TASK,
    **run: object,
) -> DataFrame:
    """``run_statements`` whose outcomes outlive a failed job: they are kept in the folder ``ledger``.

    Statement rows that the ledger holds an outcome of, of this call or an earlier one, are not run. The others go in
    waves of ``connections`` tasks with about ``per_task`` statements each. A task's outcomes are files of the ledger
    as soon as the task ends (version 2 of the file committer), whatever becomes of the others, so a lost executor
    costs the outcomes of its running tasks at most, and their statements, which must be safe to repeat, are run
    again. Whatever goes wrong outside of a statement ends the call with an error, after the tasks of its wave have
    kept what they finished; calling again goes on from there.

    Returns the newest outcome of each statement row: its columns without ``statement``, with ``error``, ``error_kind``
    and ``applied_at``. Rows that are equal in all columns are one.
    """
    spark = statements.sparkSession
    connections = connections or spark.sparkContext.defaultParallelism
    shown = F.to_json(F.struct(*statements.columns), {"ignoreNullFields": "false"})
    rows = not_blank(statements).withColumn(STATEMENT_ID, F.sha2(shown, 256)).dropDuplicates([STATEMENT_ID])
    spark.createDataFrame([], _ledger_schema(statements)).write.mode("append").parquet(ledger)
    rows, done = stage(rows, "statements"), read_ledger(statements, ledger)
    open_rows = rows.join(done.select(STATEMENT_ID), STATEMENT_ID, "left_anti")
    waves = math.ceil(open_rows.count() / (connections * per_task))
    if waves:
        path = staging_path(spark, "waves")
        wave = F.pmod(F.xxhash64(STATEMENT_ID), F.lit(waves)).cast("int")
        by_wave = open_rows.withColumn("wave", wave).repartition("wave")
        by_wave.write.partitionBy("wave").parquet(path)
        read = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("wave", T.IntegerType())])).parquet(path)
    attempt = uuid.uuid4().hex
    for wave in range(waves):
        watch = Observation()
        own = read.filter(F.col("wave") == wave).drop("wave")
        outcomes = run_statements(own, connect, connections, stop=True, **run).withColumn(ATTEMPT, F.lit(attempt))
        stopped = F.when(F.col("error_kind") == STOPPED, F.col("error"))
        seen = outcomes.observe(watch, F.max(stopped).alias("error"), F.count(stopped).alias("n"))
        seen.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger)
        if watch.get["n"]:
            raise RuntimeError(f"{watch.get['n']} tasks stopped; finished statements are kept in {ledger}: {watch.get['error']}")
    finished = skew_safe_join(read_ledger(statements, ledger), rows.select(STATEMENT_ID), [STATEMENT_ID], "left_semi")
    return finished.drop(STATEMENT_ID)
