from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from metaloom import fixed_values as fv, schemas
from metaloom.operators.keys import keyed
from metaloom.operators.merge import (
    apply_status,
    latest_status,
    update_status,
    upsert_metadata,
    upsert_small_batch,
)
from metaloom.operators.outcomes import table_outcomes
from metaloom.sources.tables import conform, empty_metadata, typed_rows
from tests.fixtures import bag, by, inventory, metadata, status

A = ("c", "s", "1", "cat", "sch", "a")
B = ("c", "s", "2", "cat", "sch", "b")
A_RENAMED = ("c", "s", "1", "CAT", "SCH", "A")

both_forms = pytest.mark.parametrize("merge", [upsert_metadata, upsert_small_batch])


def synced(spark, *rows):
    """A keyed table whose records all carry a successful sync."""
    done = {fv.ACCOUNT: "Org-A", fv.SYNC_STATUS: "success", fv.SYNC_MESSAGE: "ok"}
    df = keyed(inventory(spark, *rows))
    for name, value in done.items():
        df = df.withColumn(name, F.lit(value))
    return df.withColumn(fv.SYNC_DATE, F.lit(datetime(2024, 1, 1)).cast("timestamp"))


@both_forms
class TestUpsert:
    def test_insert_into_empty(self, spark, merge):
        after = merge(empty_metadata(spark), keyed(inventory(spark, A, B)))
        assert after.schema.simpleString() == schemas.METADATA.simpleString()
        assert bag(after) == bag(keyed(inventory(spark, A, B)))

    def test_update_keeps_ids_and_status(self, spark, merge):
        after = merge(synced(spark, A), keyed(inventory(spark, A_RENAMED))).collect()
        assert len(after) == 1
        row = after[0].asDict()
        assert [row[c] for c in schemas.SOURCE_NAMES] == ["CAT", "SCH", "A"]
        assert (row[fv.ACCOUNT], row[fv.SYNC_STATUS], row[fv.SYNC_MESSAGE]) == ("Org-A", "success", "ok")
        assert row[fv.SYNC_DATE] == datetime(2024, 1, 1)

    def test_update_may_set_null(self, spark, merge):
        batch = keyed(inventory(spark, A)).withColumn(fv.TABLE_LOCATION, F.lit(None).cast("string"))
        assert merge(synced(spark, A), batch).first()[fv.TABLE_LOCATION] is None

    def test_absent_records_stay(self, spark, merge):
        after = by(merge(synced(spark, A, B), keyed(inventory(spark, A_RENAMED))), fv.TABLE_ID)
        assert after["1"][fv.TABLE_NAME] == "A" and after["2"][fv.TABLE_NAME] == "b"

    def test_new_records_have_no_status(self, spark, merge):
        after = by(merge(synced(spark, A), keyed(inventory(spark, A, B))), fv.TABLE_ID)
        assert after["1"][fv.SYNC_STATUS] == "success"
        assert [after["2"][c] for c in schemas.SYNC] == [None] * 4

    def test_twice_is_once(self, spark, merge):
        batch = keyed(inventory(spark, A_RENAMED, B))
        once = merge(synced(spark, A), batch)
        assert bag(merge(once, batch)) == bag(once)

    def test_empty_batch_changes_nothing(self, spark, merge):
        before = synced(spark, A, B)
        assert bag(merge(before, keyed(inventory(spark)))) == bag(before)

    def test_repeated_id_is_refused(self, spark, merge):
        with pytest.raises(PySparkException, match="batch repeats record id"):
            merge(synced(spark, A), keyed(inventory(spark, A, A_RENAMED))).collect()
        with pytest.raises(PySparkException, match="batch repeats record id"):
            merge(empty_metadata(spark), keyed(inventory(spark, B, B))).collect()

    def test_missing_id_is_refused(self, spark, merge):
        with pytest.raises(PySparkException, match="without a record id"):
            merge(synced(spark, A), keyed(inventory(spark, ("c", None, "1", "x", "y", "z")))).collect()

    def test_hash_collision_is_refused(self, spark, merge):
        before = synced(spark, A).withColumn(fv.TABLE_ID, F.lit("other"))
        with pytest.raises(PySparkException, match="different tables share record id"):
            merge(before, keyed(inventory(spark, A))).collect()


class TestStatus:
    def table(self, spark):
        return metadata(spark, {fv.RECORD_ID: 1, fv.TABLE_NAME: "a"}, {fv.RECORD_ID: 2, fv.SYNC_STATUS: "failed"})

    def test_update(self, spark):
        after = update_status(self.table(spark), status(spark, (1, "Org-A", "success", "ok", 2)))
        rows = by(after, fv.RECORD_ID)
        assert after.schema.simpleString() == schemas.METADATA.simpleString()
        assert [rows[1][c] for c in schemas.SYNC] == ["Org-A", datetime(2024, 1, 2), "success", "ok"]
        assert rows[1][fv.TABLE_NAME] == "a" and rows[2][fv.SYNC_STATUS] == "failed"

    def test_null_values_overwrite(self, spark):
        after = update_status(self.table(spark), status(spark, (2, None, None, None, 2)))
        assert by(after, fv.RECORD_ID)[2][fv.SYNC_STATUS] is None

    def test_unknown_ids_are_dropped(self, spark):
        after = update_status(self.table(spark), status(spark, (9, "x", "y", "z", 1)))
        assert bag(after) == bag(self.table(spark))

    def test_empty_batch(self, spark):
        assert bag(update_status(self.table(spark), status(spark))) == bag(self.table(spark))

    def test_repeated_id_is_refused(self, spark):
        batch = status(spark, (1, "a", "success", "m", 1), (1, "a", "failed", "m", 2))
        with pytest.raises(PySparkException, match="repeats record id"):
            update_status(self.table(spark), batch).collect()

    def test_newest_wins_in_a_log(self, spark):
        log = status(
            spark,
            (1, "a", "failed", "first", 1),
            (1, "a", "success", "last", 3),
            (1, "a", "failed", "second", 2),
            (9, "a", "success", "unknown", 9),
        )
        rows = by(apply_status(self.table(spark), log), fv.RECORD_ID)
        assert rows[1][fv.SYNC_MESSAGE] == "last" and set(rows) == {1, 2}

    def test_a_log_equals_its_batches_in_turn(self, spark):
        days = [status(spark, (1 + d % 2, "a", "failed", f"day {d}", d)) for d in range(1, 5)]
        table, log = self.table(spark), days[0]
        for day in days:
            table = update_status(table, day)
        for day in days[1:]:
            log = log.union(day)
        assert bag(apply_status(self.table(spark), log)) == bag(table)

    def test_ties_do_not_depend_on_order(self, spark):
        rows = [(1, "a", "failed", "x", 1), (1, "a", "success", "y", 1)]
        one = latest_status(status(spark, *rows)).collect()
        assert one == latest_status(status(spark, *reversed(rows))).collect()


def test_table_outcomes_as_status_rows(spark):
    when = datetime(2024, 5, 6)
    log = typed_rows(
        spark, [(1, "t1", None, None, when), (2, "t2", "bad", "compile", when)], schemas.OUTCOMES
    )
    rows = table_outcomes(log, "Org-A")
    assert rows.schema.simpleString() == schemas.STATUS.simpleString()
    assert bag(rows) == [
        (1, "Org-A", "success", "Table 't1' created successfully.", when),
        (2, "Org-A", "failed", "SQL compilation error: bad", when),
    ]
    stamped = table_outcomes(log, "Org-A", F.lit("2030-01-01").cast("timestamp"))
    assert {r[fv.SYNC_DATE] for r in stamped.collect()} == {datetime(2030, 1, 1)}


def test_typed_rows_need_no_inference(spark):
    assert typed_rows(spark, [], schemas.STATUS).schema == schemas.STATUS
    assert typed_rows(spark, [(1, None, None, None, None)], schemas.STATUS).count() == 1


def test_conform_fills_and_orders(spark):
    columns = f"{fv.TABLE_NAME} string, {fv.RECORD_ID} int, more boolean"
    df = conform(spark.createDataFrame([("x", 1, True)], columns), schemas.METADATA)
    assert df.columns == schemas.METADATA.names
    assert df.first()[fv.RECORD_ID] == 1 and df.first()[fv.SYNC_DATE] is None
