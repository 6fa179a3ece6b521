"""What the search for hard negatives sends to the driver, and how visits are gathered."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from metaloom.llm import hard_negatives as hn
from metaloom.llm.hard_negatives import MultiIndex, hard_negatives
from tests.llm.test_hard_negatives import SCHEMA, brute, clustered, found


def test_the_driver_gets_centres_and_no_sample(spark, conf, monkeypatch):
    conf(
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__files__openCostInBytes="1k",
        spark__sql__files__maxPartitionBytes="96k",
    )
    monkeypatch.setattr(hn, "SAMPLE_ROWS", 400)
    rows = clustered(2400, 64, 12, 0.3, 7)  # 1.2 MB, of which no partition has more rows than the sample
    most = spark.sparkContext._jsc.sc().conf()
    was = most.get("spark.driver.maxResultSize", "1g")
    most.set("spark.driver.maxResultSize", "600k")
    try:
        got = found(hard_negatives(spark.createDataFrame(rows, SCHEMA), cell_rows=200))
    finally:
        most.set("spark.driver.maxResultSize", was)
    want = brute(rows)
    assert got == want and sum(want.values()) > 20


def test_the_sample_is_the_rows_of_least_hash(spark, monkeypatch):
    monkeypatch.setattr(hn, "SAMPLE_ROWS", 50)
    rng = np.random.default_rng(5)
    data = [(7, "a", np.floor(rng.normal(0, 99, 5)).tobytes()) for _ in range(900)]  # one id, many vectors
    rows = spark.createDataFrame(data, "vec_id long, label string, vector binary").repartition(6)
    least = rows.orderBy(hn.F.xxhash64("vec_id", "label", "vector", hn.F.lit(3)), "vector").limit(50).collect()
    sample, own = hn.matrix([bytes(r["vector"]) for r in least]), np.random.default_rng(3)
    want = [hn.fit_centres(half, 4, own) for half in (sample[:, :3], sample[:, 3:])]
    for got, centres in zip(hn._fitted(rows, 900, 4, 3), want, strict=True):
        assert got.shape == centres.shape and (got == centres).all()


def test_visits_are_not_broadcast(spark, monkeypatch):
    plans, plain = [], hn.stage

    def stage(df, name):
        if name == "found":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(hn, "stage", stage)
    rows = clustered(300, 6, 5, 0.3, 8)
    assert found(hard_negatives(spark.createDataFrame(rows, SCHEMA), cell_rows=30)) == brute(rows)
    assert plans and not any("BroadcastExchange" in p for p in plans)


def test_visits_are_gathered_by_cell_and_let_go(monkeypatch):
    monkeypatch.setattr(hn, "VISIT_ROWS", 5)
    monkeypatch.setattr(hn, "PENDING_VISITS", 40)
    monkeypatch.setattr(hn, "PENDING_BYTES", 3000)
    rng = np.random.default_rng(6)
    centres = (rng.normal(0, 200, (3, 2)), rng.normal(0, 200, (3, 2)))
    index = MultiIndex(centres, (np.full(3, 30.0), np.full(3, 30.0)), np.ones(9, np.int64))
    windows = [[{"wid": 1, "low": -20_000, "high": 20_000}, {"wid": 2, "low": 60_000, "high": 90_000}]]
    batches = []
    for at in range(0, 60, 12):
        vectors = np.floor(rng.normal(0, 200, (12, 4)))
        columns = [range(at, at + 12), range(at, at + 12), ["x"] * 12, [v.tobytes() for v in vectors], windows * 12]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary(), hn._WINDOWS_ARROW)
        arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds)]
        batches.append(pa.RecordBatch.from_arrays(arrays, names=["uid", "vec_id", "label", "vector", "windows"]))
    want = set()
    for batch in batches:
        for at, order in enumerate(hn._ordered(index, batch, 7)):
            met = {c for b, c, low in order[1:7] if any(b >= w["low"] and low <= w["high"] for w in windows[0])}
            want |= {(batch.column(0)[at].as_py(), batch.column(3)[at].as_py(), c) for c in met}
    got, sizes = [], []
    for out in hn._visits(SimpleNamespace(value=index), 1, 7, 4)(iter(batches)):
        for cell, asking in zip(*(c.to_pylist() for c in out.columns), strict=True):
            sizes.append(len(asking))
            got += [(a["uid"], a["vector"], cell) for a in asking]
            assert all(a["windows"] == windows[0] for a in asking)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    assert 1 <= min(sizes) and 1 < max(sizes) <= 4
