"""Approximate nearest neighbours along shifted space-filling curves."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from metaloom.operators.joins import skew_safe_join
from metaloom.session import stage

#: Curves, each through another random projection with another shift, to so many dimensions and bits of each.
CURVES, DIMENSIONS, BITS = 4, 6, 10
#: Distinct vectors in a cell of a curve, and queries that meet it at once, at most or about.
CELL_ROWS, QUERY_ROWS = 4096, 1024
#: Lists of a query's results that are merged at a time.
MERGED = 64
#: Vectors that projections are scaled by, and queries that set the window, at most.
SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 100
#: Recall the window is set for on the sampled queries: over all of them, and of each but the worst tenth.
TARGET_RECALL, WORST_RECALL = 0.95, 0.8

_BYTES, _IDS, _FLAGS = pa.list_(pa.binary()), pa.list_(pa.list_(pa.int64())), pa.list_(pa.bool_())


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points with coordinates of ``bits`` bits.

    The bits of each point are taken from the highest down. The rotation and reflection that the curve has in
    the cell reached so far are undone on the lower bits, and the Gray rank of the corner is the next digit.
    """
    axes = points.T.astype(np.int64)
    n = len(axes)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(n):
            upper = (axes[i] >> bit) & 1 == 1
            flipped = axes[0] ^ low
            swap = np.where(upper, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(upper, flipped, axes[0] ^ swap)
            axes[i] ^= swap if i else 0
    for i in range(1, n):
        axes[i] ^= axes[i - 1]
    carry = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        carry ^= np.where((axes[n - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    axes ^= carry
    keys = np.zeros(points.shape[0], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            keys = (keys << 1) | ((axes[i] >> bit) & 1)
    return keys


@dataclass
class Curves:
    """Projections and shifts; bounded by the vectors' length, so it can go to every task."""

    centre: np.ndarray
    bases: list[np.ndarray]
    shifts: list[np.ndarray]

    @staticmethod
    def fit(sample: np.ndarray, seed: int, curves: int = CURVES) -> Curves:
        rng = np.random.default_rng(seed)
        centre = sample.mean(axis=0)
        bases, shifts = [], []
        for _ in range(curves):
            dims = min(DIMENSIONS, sample.shape[1])
            base = np.linalg.qr(rng.normal(size=(sample.shape[1], dims)))[0]
            spread = ((sample - centre) @ base).std(axis=0)
            bases.append(base / np.where(spread > 0, spread, 1))
            shifts.append(rng.random(dims))
        return Curves(centre, bases, shifts)

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        top = (1 << BITS) - 1
        places = []
        for base, shift in zip(self.bases, self.shifts, strict=True):
            unit = (((vectors - self.centre) @ base) / 6 + 0.5 + shift) / 2
            places.append(hilbert_keys(np.clip(unit * (top + 1), 0, top).astype(np.int64), BITS))
        return places


def _matrix(column: pa.Array | list[bytes]) -> np.ndarray:
    data = [np.frombuffer(b, "<f8") for b in (column if isinstance(column, list) else column.to_pylist())]
    return np.stack(data) if data else np.empty((0, 1))


def _packed(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, vector``: doubles as bytes. Vectors that take no part are left out."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")
    ).filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(sound & F.exists("v", lambda x: x != 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.array(v, "<f8") + 0.0 for v in batch.column(1).to_pylist()]  # no negative zeros
            arrays = [batch.column(0), pa.array([v.tobytes() for v in data], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "vector"])

    return rows.mapInArrow(pack, "vec_id long, vector binary")


def _best(scores: np.ndarray, firsts: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties by the smaller first id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((firsts[near], -scores[near]))][:k]


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    seed: int = 0,
    target: float = TARGET_RECALL,
    cell_rows: int = CELL_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` rows found with the largest inner products to each query, a row whose id ``every`` divides.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller id, and a query is not its own neighbour.

    Vectors are projected at random to a few dimensions and ordered along a shifted Hilbert curve, several times. Spark
    deals each order by ranges of its keys (and of a hash, where keys are equal), sorts the ranges, and cuts them into
    cells of ``cell_rows`` vectors at most, numbered along the curve; a query is in the cells that hold it. It visits
    them and the ``w`` cells to either side on each curve, up to ``query_rows`` queries at a time, and what it finds is
    merged and ranked by exact inner products in double precision. ``w`` is the least window that finds the share
    ``target`` of all true neighbours of at most ``SAMPLE_QUERIES`` queries, and the share ``WORST_RECALL`` of those of
    nine queries in ten; these queries are searched by brute force in blocks. So the work grows with how hard the data
    are, up to all rows; where the window covers all cells, one curve is searched. Projections are scaled on
    ``SAMPLE_ROWS`` rows.

    Equal vectors are searched once: no query can have more of them than their ``k + 1`` smallest ids. Rows with a
    null id, or with a vector that is null, empty or zero, or that holds null or non-finite numbers, take no part.
    Vectors of different lengths do not meet: each length is searched on its own. Rows that repeat an id and a vector
    count once; an id with several vectors is several rows. An empty table, or one without queries or candidates,
    gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stage(_packed(vectors, vec_id, embedding).distinct(), "vectors")
    result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for (size,) in rows.select(F.length("vector")).distinct().collect():
        own = rows.filter(F.length("vector") == size)
        result = result.unionByName(_of_one_length(own, every, k, seed, target, cell_rows, query_rows))
    return result


def _of_one_length(
    rows: DataFrame, every: int, k: int, seed: int, target: float, cell_rows: int, query_rows: int
) -> DataFrame:
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    ranked = rows.withColumn("at", F.row_number().over(smallest)).filter(F.col("at") <= k + 1)
    kinds = ranked.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    kinds = kinds.join(asked.select("vector", F.lit(True).alias("asks")).distinct(), "vector", "left")
    kinds = stage(kinds, "distinct-vectors")

    by_hash = F.xxhash64("vector", F.lit(seed))
    sample = [np.frombuffer(r[0], "<f8") for r in kinds.select("vector").orderBy(by_hash).limit(SAMPLE_ROWS).collect()]
    if not sample:
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    cells, count = _cells(kinds, Curves.fit(np.stack(sample), seed), seed, cell_rows)
    width = _window(cells, seed, k, target) if count > 1 else 0
    if width >= count - 1:
        cells = cells.filter("curve = 0")
    visits = cells.mapInArrow(_queries, "vector binary, curve int, own int").select(
        "vector",
        "curve",
        F.explode(
            F.sequence(F.greatest(F.lit(0), F.col("own") - width), F.least(F.lit(count - 1), F.col("own") + width))
        ).alias("cell"),
    )
    groups = max(1, math.ceil(asked.count() / query_rows))
    asking = visits.groupBy("curve", "cell", F.pmod(F.xxhash64("vector"), F.lit(groups)).alias("grp")).agg(
        F.collect_list("vector").alias("asking")
    )
    held = cells.select("curve", "cell", "vectors", "ids")
    met = skew_safe_join(asking.select("curve", "cell", "asking"), held, ["curve", "cell"], "inner")
    place = (F.col("curve") * count + F.col("cell")).cast("int").alias("place")
    found = met.select(place, "asking", "vectors", "ids").mapInArrow(
        _search(k), "place int, vector binary, best array<struct<less:double,vec_id:long>>"
    )
    best = F.slice(F.array_distinct(F.sort_array(F.flatten(F.collect_list("best")))), 1, k + 1).alias("best")
    left = count * (1 if width >= count - 1 else CURVES)
    while True:  # a query has MERGED lists to merge at a time, however many cells it has visited
        found = found.groupBy("vector", F.floor(F.col("place") / MERGED).cast("int").alias("place")).agg(best)
        left = math.ceil(left / MERGED)
        if left == 1:
            break
    near = skew_safe_join(asked, found.select("vector", "best"), ["vector"], "inner")
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranks = near.select("query_id", F.posexplode(others).alias("at", "near"))
    return ranks.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("near.vec_id").alias("vec_id"),
        (F.lit(0.0) - F.col("near.less")).alias("score"),
    )


def _cells(kinds: DataFrame, curves: Curves, seed: int, cell_rows: int) -> tuple[DataFrame, int]:
    """``curve, cell, vectors, ids, asks``: cells in the order of each curve, and how many a curve has at most."""
    spark = kinds.sparkSession
    shared = spark.sparkContext.broadcast(curves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keys = np.stack(shared.value.keys(_matrix(part.column(0))), axis=1)
                names = [*part.schema.names, "keys"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(keys), pa.list_(pa.int64()))], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Consecutive rows of a curve as cells, numbered within the partition."""
        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        curve, size = -1, 0

        def close() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            lists = [pa.array([whole.column(c).to_pylist()], t) for c, t in (("vector", _BYTES), ("ids", _IDS), ("asks", _FLAGS))]
            numbers = [pa.array([v], pa.int32()) for v in (curve, part, number)]
            return pa.RecordBatch.from_arrays([*numbers, *lists], names=["curve", "part", "number", "vectors", "ids", "asks"])

        for batch in batches:
            at = 0
            kinds = batch.column("curve").to_numpy()
            while at < batch.num_rows:
                if held and (kinds[at] != curve or size == cell_rows):
                    yield close()
                    held, size, number = [], 0, number + 1
                curve = int(kinds[at])
                same = int(np.searchsorted(kinds[at:], curve, side="right"))
                n = min(same, cell_rows - size)
                held.append(batch.slice(at, n))
                at, size = at + n, size + n
        if held:
            yield close()

    placed = kinds.mapInArrow(place, "vector binary, ids array<long>, asks boolean, keys array<long>")
    placed = placed.select("vector", "ids", "asks", F.posexplode("keys").alias("curve", "key"))
    order = ("curve", "key", F.xxhash64("vector", F.lit(seed)))
    sorted_rows = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = sorted_rows.mapInArrow(
        cut, "curve int, part int, number int, vectors array<binary>, ids array<array<long>>, asks array<boolean>"
    )
    blocks = stage(blocks, "cells")
    # cells of each partition, which are as many as shuffle partitions at most, give every cell its place on the curve
    before: dict[int, int] = {}
    starts = []
    for curve, part, first, n in sorted(
        tuple(r) for r in blocks.groupBy("curve", "part").agg(F.min("number"), F.count("*")).collect()
    ):
        starts.append((curve, part, before.get(curve, 0) - first))
        before[curve] = before.get(curve, 0) + n
    offsets = spark.createDataFrame(starts, "curve int, part int, start int")
    numbered = blocks.join(offsets, ["curve", "part"]).select(
        "curve", (F.col("start") + F.col("number")).cast("int").alias("cell"), "vectors", "ids", "asks"
    )
    return numbered, max(before.values())


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query vectors of cells, with their curve and cell."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1).to_pylist()[0]
            own = [v for v, asks in zip(one["vectors"], one["asks"], strict=True) if asks]
            arrays = [pa.array(own, pa.binary()), *(pa.array([one[c]] * len(own), pa.int32()) for c in ("curve", "cell"))]
            yield pa.RecordBatch.from_arrays(arrays, names=["vector", "curve", "own"])


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products that do not depend on what else is in a block, so that curves agree on them."""
    return (rows * query).sum(axis=1)


def _search(k: int):
    """The ``k + 1`` best rows of a cell for each of the queries that meet it, by negative score and id."""
    kind = pa.list_(pa.struct([("less", pa.float64()), ("vec_id", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                place, asking, vectors, own = (batch.column(c)[row].as_py() for c in ("place", "asking", "vectors", "ids"))
                held, firsts = _matrix(vectors), np.array([i[0] for i in own])
                found = []
                for at in range(0, len(asking), 256):
                    wanted = _matrix(asking[at : at + 256])
                    for query, line in zip(wanted, wanted @ held.T, strict=True):
                        best = _best(line, firsts, k + 1)
                        scores = _exact(query, held[best])
                        pairs = sorted((-float(score), i) for b, score in zip(best, scores, strict=True) for i in own[b])
                        found.append([{"less": less, "vec_id": i} for less, i in pairs[: k + 1]])
                arrays = [pa.array([place] * len(asking), pa.int32()), pa.array(asking, pa.binary()), pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays(arrays, names=["place", "vector", "best"])

    return search


def _window(cells: DataFrame, seed: int, k: int, target: float) -> int:
    """The least number of cells to either side that holds the wanted shares of the true neighbours, without the query."""
    places = cells.mapInArrow(_queries, "vector binary, curve int, own int")
    tried = places.filter("curve = 0").orderBy(F.xxhash64("vector", F.lit(seed))).limit(SAMPLE_QUERIES).select("vector")
    known: dict[bytes, dict[int, int]] = {}
    for row in places.join(F.broadcast(tried), "vector").collect():  # a row for each sampled query and curve
        known.setdefault(bytes(row["vector"]), {})[row["curve"]] = row["own"]
    queries = sorted(known)
    if not queries:
        return 0
    asked = _matrix(queries)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ``k`` best of each query among the task's cells, and the fewest cells away that they are."""
        best: list[dict[bytes, tuple[float, int]]] = [{} for _ in queries]
        for batch in batches:
            for row in range(batch.num_rows):
                curve, cell, vectors = (batch.column(c)[row].as_py() for c in ("curve", "cell", "vectors"))
                held, places = _matrix(vectors), np.arange(len(vectors))
                for i, line in enumerate(asked @ held.T):
                    near, away = best[i], abs(cell - known[queries[i]][curve])
                    first = [b for b in _best(line, places, k + 1) if vectors[b] != queries[i]]
                    for b, score in zip(first, _exact(asked[i], held[first]), strict=True):
                        near[vectors[b]] = (float(score), min(away, near.get(vectors[b], (0, away))[1]))
                    best[i] = dict(sorted(near.items(), key=lambda x: (-x[1][0], x[0]))[:k])
        rows = [(i, near, *own) for i, found in enumerate(best) for near, own in found.items()]
        types = (pa.int32(), pa.binary(), pa.float64(), pa.int32())
        arrays = [pa.array([r[c] for r in rows], t) for c, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, names=["query", "near", "score", "away"])

    found = cells.select("curve", "cell", "vectors").mapInArrow(brute, "query int, near binary, score double, away int")
    once = found.groupBy("query", "near").agg(F.max("score").alias("score"), F.min("away").alias("away"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "near")
    best = once.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k)
    away: dict[int, list[int]] = {}
    for row in best.select("query", "away").collect():  # k rows for each sampled query
        away.setdefault(row["query"], []).append(row["away"])

    def least(values: list[int], share: float) -> int:
        return sorted(values)[max(0, math.ceil(share * len(values)) - 1)]

    if not away:
        return 0
    each = [least(own, WORST_RECALL) for own in away.values()]
    return max(least([a for own in away.values() for a in own], target), least(each, 0.9))
