"""Hard-negative mining over an inverted multi-index."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from metaloom.operators.joins import skew_safe_join
from metaloom.session import stage

#: Rows of a cell on average, of a block of a cell, and anchors that meet a block at once.
CELL_ROWS, BLOCK_ROWS, ANCHOR_ROWS = 4096, 2048, 512
#: Centres of each half at most; the table of cells, which the driver holds, has their square of entries.
MAX_CENTRES = 64
#: Rows that the codebooks are fitted on, at most, and rounds of fitting. All rows are indexed.
SAMPLE_ROWS, FIT_ROUNDS = 20_000, 10
#: Times the rows of the sample that are expected below the hash under which it is looked for.
SAMPLE_MARGIN = 1.1
#: Visits that leave a task at once, each with its anchor's vector, and visits and bytes of anchors that a task gathers.
VISIT_ROWS, PENDING_VISITS, PENDING_BYTES = 4096, 1 << 21, 32 << 20
#: After round r an anchor has visited the first FIRST_CELLS * MORE^r cells of its order.
FIRST_CELLS, MORE = 4, 4
#: Above any product of integers that floating point may round.
_EXACT = float(2**53)

_WINDOWS = "array<struct<wid:int,low:long,high:long>>"
_ASKED = f"uid long, vec_id long, label string, vector binary, windows {_WINDOWS}"
_VISITS = f"cell long, asking array<struct<uid:long,vec_id:long,label:string,vector:binary,windows:{_WINDOWS}>>"
_WINDOWS_ARROW = pa.list_(pa.struct([("wid", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]))


def matrix(column: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(b, "<f8") for b in column]) if column else np.empty((0, 0))


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors; those beyond 64 bits raise."""
    most = (np.abs(left).max(initial=0)) * (np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if most < _EXACT:
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (left, right)]
    return np.array((whole[0] @ whole[1].T).tolist(), np.int64).reshape(len(left), len(right))


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)
    return np.maximum(squares, 0)


def fit_centres(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``k`` centres by Lloyd's rounds from random distinct points."""
    kinds = np.unique(points, axis=0)
    centres = kinds[rng.choice(len(kinds), min(k, len(kinds)), replace=False)].astype(float)
    for _ in range(FIT_ROUNDS):
        own = _distances(points, centres).argmin(axis=1)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


@dataclass
class MultiIndex:
    """Two codebooks, one for each half of a vector, the radius around each centre over all rows, and the rows of each
    cell, a pair of centres. Its size is bounded by ``MAX_CENTRES`` and the vectors' length."""

    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.centres[0].shape[1]
        return vectors[:, :cut], vectors[:, cut:]

    def place(self, vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Nearest centre of each half, and how far it is."""
        own, far = [], []
        for half, centres in zip(self.halves(vectors), self.centres, strict=True):
            own.append(_distances(half, centres).argmin(axis=1))
            far.append(np.linalg.norm(half - centres[own[-1]], axis=1))
        return own, far

    def reaches(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: inner products with the centres, and how much a row around one may differ from them.

        The difference is the norm of the half times the radius, and a little for rounding.
        """
        out = []
        for half, centres, radii in zip(self.halves(vectors), self.centres, self.radii, strict=True):
            norms = np.linalg.norm(half, axis=1)[:, None]
            slack = 1e-9 * norms * (np.linalg.norm(centres, axis=1) + radii) + 1e-6
            out.append((half @ centres.T, norms * radii + slack))
        return out


def cell_order(first: np.ndarray, second: np.ndarray, rows: np.ndarray) -> Iterator[tuple[float, int]]:
    """Cells that hold rows, by falling sum of their halves' bounds: ``bound, cell``.

    The multi-sequence algorithm: both lists of bounds are sorted, and a heap holds the pairs whose neighbours before
    them, in both lists, have been visited.
    """
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[one[0]] + second[two[0]]), 0, 0)]
    taken = np.zeros(len(one), np.int64)  # for each place in the first list, how far the second has been visited
    while heap:
        bound, i, j = heapq.heappop(heap)
        taken[i] = j + 1
        cell = int(one[i]) * len(two) + int(two[j])
        if rows[cell]:
            yield -bound, cell
        if i + 1 < len(one) and taken[i + 1] == j:
            heapq.heappush(heap, (-(first[one[i + 1]] + second[two[j]]), i + 1, j))
        if j + 1 < len(two) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (-(first[one[i]] + second[two[j + 1]]), i, j + 1))


def _packed(vectors: DataFrame, vec_id: str, label: str, embedding: str, scale: float) -> DataFrame:
    """``vec_id, label, vector``: the floors of the scaled components, as bytes of doubles; rows that take part only."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<double>").alias("v"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [(np.floor(np.array(v, "<f8") * scale) + 0.0).tobytes() for v in batch.column(2).to_pylist()]
            arrays = [batch.column(0), batch.column(1), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "vector"])

    return rows.mapInArrow(pack, "vec_id long, label string, vector binary").distinct()


def _fitted(rows: DataFrame, size: int, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The centres of both halves, fitted in one task on the ``SAMPLE_ROWS`` of ``size`` rows that have the least hashes.

    The driver gets no row, only centres. Sorting with a limit keeps that many rows of every partition, so rows beyond a
    hash that the sample hardly reaches are dropped before. Rows differ, and so do their hashes.
    """
    drawn = rows.select("vector", F.xxhash64("vec_id", "label", "vector", F.lit(seed)).alias("at"))
    share = SAMPLE_MARGIN * SAMPLE_ROWS / size
    if share < 1:
        drawn = drawn.filter(F.col("at") <= int(share * 2**64) - 2**63)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [matrix(batch.column("vector").to_pylist()) for batch in batches if batch.num_rows]
        if parts:
            sample, rng = np.concatenate(parts), np.random.default_rng(seed)
            cut = (sample.shape[1] + 1) // 2
            halves = [fit_centres(half, k, rng) for half in (sample[:, :cut], sample[:, cut:])]
            columns = [[0, 1], *zip(*(c.shape for c in halves), strict=True), [c.astype("<f8").tobytes() for c in halves]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["half", "n", "width", "centres"])

    least = drawn.orderBy("at", "vector").limit(SAMPLE_ROWS).select("vector").coalesce(1)
    found = least.mapInArrow(fit, "half long, n long, width long, centres binary").collect()
    by_half = sorted(found, key=lambda r: r["half"])
    first, second = (np.frombuffer(bytes(r["centres"]), "<f8").reshape(r["n"], r["width"]) for r in by_half)
    return first, second


class _Searcher:
    """Searches rows of one length, kept as blocks of the cells of a multi-index."""

    def __init__(self, rows: DataFrame, seed: int, cell_rows: int, block_rows: int, anchor_rows: int):
        spark = rows.sparkSession
        self.anchor_rows = anchor_rows
        size = max(1, rows.count())
        k = min(MAX_CENTRES, math.ceil(math.sqrt(math.ceil(size / cell_rows))))
        centres = _fitted(rows, size, k, seed)
        bare = MultiIndex(centres, (np.zeros(0), np.zeros(0)), np.zeros(0))
        fitted = spark.sparkContext.broadcast(bare)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own, far = fitted.value.place(matrix(batch.column("vector").to_pylist()))
                cell = own[0] * len(fitted.value.centres[1]) + own[1]
                arrays = [*batch.columns, pa.array(cell, pa.int64()), *(pa.array(f, pa.float64()) for f in far)]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "vector", "cell", "far1", "far2"])

        kinds = "vec_id long, label string, vector binary, cell long, far1 double, far2 double"
        placed = stage(rows.mapInArrow(place, kinds), "placed")
        cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far1").alias("far1"), F.max("far2").alias("far2"))
        counts = np.zeros(len(centres[0]) * len(centres[1]), np.int64)
        radii = [np.zeros(len(c)) for c in centres]
        for row in cells.collect():  # at most the square of MAX_CENTRES
            counts[row["cell"]] = row["n"]
            for radius, at, far in zip(radii, divmod(row["cell"], len(centres[1])), (row["far1"], row["far2"]), strict=True):
                radius[at] = max(radius[at], far)
        self.index = spark.sparkContext.broadcast(MultiIndex(centres, (radii[0], radii[1]), counts))
        self.cells = int((counts > 0).sum())
        sizes = cells.select("cell", F.ceil(F.col("n") / block_rows).cast("long").alias("parts"))
        part = F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts")).alias("part")
        held = F.collect_list(F.struct("vec_id", "label", "vector")).alias("held")
        dealt = placed.join(sizes, "cell").select("cell", part, "vec_id", "label", "vector")
        self.blocks = stage(dealt.groupBy("cell", "part").agg(held).select("cell", "held"), "blocks")

    def search(self, asked: DataFrame, k: int, same_label: bool) -> DataFrame:
        """The first ``k`` rows of each window of each anchor: ``uid, wid, score, id``.

        ``asked`` holds ``uid, vec_id, label, vector, windows``; a window is a range of scores. Rows count that are of
        the anchor's label, or of another, and not of its id. Anchors visit cells in the order of their bounds, some
        more in each round, until no cell ahead can hold a row that belongs to a window's first ``k``.
        """
        spark, index, cells = asked.sparkSession, self.index, self.cells
        found = spark.createDataFrame([], "uid long, wid int, score long, id long")
        seen, upto = 0, min(FIRST_CELLS, cells)
        while True:
            # A task should have enough anchors for an eighth of ``anchor_rows`` in a cell on average.
            tasks = math.ceil(8 * asked.count() * (upto - seen) / (cells * self.anchor_rows))
            visits = asked.coalesce(max(1, tasks)).mapInArrow(_visits(index, seen, upto, self.anchor_rows), _VISITS)
            # Spark plans by the size of the anchors' file, but each visit has a vector: it must not be broadcast.
            visits = visits.hint("merge")
            met = skew_safe_join(visits, self.blocks, ["cell"], "inner")
            scored = met.select("asking", "held").mapInArrow(_scores(k, same_label), found.schema)
            ranked = Window.partitionBy("uid", "wid").orderBy(F.desc("score"), "id")
            best = found.unionByName(scored).withColumn("at", F.row_number().over(ranked)).filter(F.col("at") <= k)
            found = stage(best.drop("at"), "found")
            if upto >= cells:
                return found
            last = found.groupBy("uid", "wid").agg(F.count("*").alias("n"), F.min("score").alias("last"))
            last = last.groupBy("uid").agg(F.collect_list(F.struct("wid", "n", "last")).alias("lasts"))
            state = asked.join(last, "uid", "left")
            asked = stage(state.mapInArrow(_still_open(index, upto, k), _ASKED), "open")
            if asked.isEmpty():
                return found
            seen, upto = upto, min(upto * MORE, cells)


def _ordered(index: MultiIndex, batch: pa.RecordBatch, upto: int) -> Iterator[list[tuple[float, int, float]]]:
    """For each anchor the first ``upto`` cells and the one after them: upper bound, cell, lower bound."""
    one, two = index.reaches(matrix(batch.column("vector").to_pylist()))
    wide = len(index.centres[1])
    for at in range(batch.num_rows):
        order = cell_order(one[0][at] + one[1][at], two[0][at] + two[1][at], index.rows)
        lows = one[0][at] - one[1][at], two[0][at] - two[1][at]
        yield [(b, c, lows[0][c // wide] + lows[1][c % wide]) for (b, c), _ in zip(order, range(upto + 1), strict=False)]


def _visits(shared, seen: int, upto: int, anchor_rows: int):
    """The cells that anchors visit in this round, those whose bounds meet one of their windows: ``cell, asking``, with
    up to ``anchor_rows`` anchors in a row. A task gathers its anchors by cell and lets them go before they grow many."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[pa.RecordBatch] = []
        by_cell: dict[int, list[int]] = {}
        before = visits = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if sum(b.nbytes for b in gathered) >= PENDING_BYTES:
                yield from _grouped(gathered, by_cell, anchor_rows)
                gathered, by_cell, before, visits = [], {}, 0, 0
            gathered.append(batch)
            windows = batch.column("windows").to_pylist()
            for at, order in enumerate(_ordered(shared.value, batch, upto)):
                row = before + at
                for upper, cell, lower in order[seen:upto]:
                    if any(upper >= w["low"] and lower <= w["high"] for w in windows[at]):
                        by_cell.setdefault(cell, []).append(row)
                        visits += 1
                if visits >= PENDING_VISITS:
                    yield from _grouped(gathered, by_cell, anchor_rows)
                    gathered, by_cell, before, visits = [batch], {}, 0, 0
            before += batch.num_rows
        yield from _grouped(gathered, by_cell, anchor_rows)

    return visit


def _grouped(gathered: list[pa.RecordBatch], by_cell: dict[int, list[int]], anchor_rows: int) -> Iterator[pa.RecordBatch]:
    """``cell, asking`` of the rows, numbered through ``gathered``, that visit each cell."""
    if not by_cell:
        return
    whole = pa.Table.from_batches(gathered).combine_chunks().to_batches()[0]
    cells: list[int] = []
    rows: list[int] = []
    ends = [0]
    for cell, own in by_cell.items():
        for at in range(0, len(own), anchor_rows):
            cells.append(cell)
            rows += own[at : at + anchor_rows]
            ends.append(len(rows))
            if len(rows) >= VISIT_ROWS:
                yield _visit_rows(whole, cells, rows, ends)
                cells, rows, ends = [], [], [0]
    if rows:
        yield _visit_rows(whole, cells, rows, ends)


def _visit_rows(whole: pa.RecordBatch, cells: list[int], rows: list[int], ends: list[int]) -> pa.RecordBatch:
    taken = whole.take(pa.array(rows, pa.int64()))
    anchors = pa.StructArray.from_arrays(taken.columns, names=whole.schema.names)
    asking = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), anchors)
    return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), asking], names=["cell", "asking"])


def _still_open(shared, upto: int, k: int):
    """Anchors with the windows that a cell ahead may still change."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, windows = [], []
            columns = (batch.column(c).to_pylist() for c in ("windows", "lasts"))
            for at, (order, own, lasts) in enumerate(zip(_ordered(shared.value, batch, upto), *columns, strict=True)):
                if len(order) <= upto:
                    continue
                ahead = order[upto][0]
                full = {x["wid"]: x["last"] for x in lasts or [] if x["n"] >= k}
                left = [w for w in own if ahead >= w["low"] and not full.get(w["wid"], -math.inf) > ahead]
                if left:
                    rows.append(at)
                    windows.append(left)
            taken = batch.take(pa.array(rows, pa.int64()))
            kept = [taken.column(c) for c in ("uid", "vec_id", "label", "vector")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(windows, _WINDOWS_ARROW)], names=["uid", "vec_id", "label", "vector", "windows"]
            )

    return keep


def _scores(k: int, same_label: bool):
    """Of a group of anchors and a block: the first ``k`` rows of each window."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asking, held in zip(batch.column("asking"), batch.column("held"), strict=True):
                asking, held = asking.as_py(), held.as_py()
                ids = np.array([h["vec_id"] for h in held], np.int64)
                scores = inner_products(matrix([a["vector"] for a in asking]), matrix([h["vector"] for h in held]))
                codes = {x: i for i, x in enumerate({h["label"] for h in held})}
                labels = np.array([codes[h["label"]] for h in held])
                out: list[tuple[int, int, int, int]] = []
                for asks, line in zip(asking, scores, strict=True):
                    fits = (labels == codes.get(asks["label"], -1)) == same_label
                    fits &= ids != asks["vec_id"]
                    near = np.flatnonzero(fits)
                    near = near[np.lexsort((ids[near], -line[near]))]
                    falling = -line[near]
                    for w in asks["windows"]:
                        start = np.searchsorted(falling, -w["high"], side="left")
                        stop = np.searchsorted(falling, -w["low"], side="right")
                        for i in near[start : min(stop, start + k)]:
                            out.append((asks["uid"], w["wid"], int(line[i]), int(ids[i])))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                arrays = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(arrays, names=["uid", "wid", "score", "id"])

    return score


def _floor_percent(product: Column) -> Column:
    """``floor(product / 100)`` in integers."""
    return F.call_function("div", product - F.pmod(product, F.lit(100)), F.lit(100))


_LEAST, _MOST = -(1 << 62), 1 << 62
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: float = 256.0,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    seed: int = 0,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """Rows of other labels that score nearly as high with an anchor as its positives do.

    Anchors are rows whose id ``every`` divides. A component x counts as ``floor(scale * x)``, and a row's score is its
    integer inner product with the anchor; higher scores come first, ties by smaller id. An anchor's positives are its
    first ``positives`` other rows of its label. For each, the first ``negatives`` rows of other labels come back whose
    score is at least ``low_percent`` and at most ``high_percent`` of the positive's: ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``. Results are exact.

    Vectors are cut in halves and each half has a codebook; a cell is a pair of centres. No row of a cell can score
    above the sum of its halves' bounds, each the inner product with the centre plus the norm of the anchor's half times
    the radius. A heap visits cells by falling bounds (``cell_order``), first for the positives and then for their
    windows, and an anchor stops when the next bound is below what it has found or below its windows. Cells are kept as
    blocks of about ``block_rows`` rows, dealt by hash, and a block meets at most about ``anchor_rows`` anchors at once,
    so a crowded cell is many tasks and no group grows with the table. Data without structure make anchors visit most
    cells, and then the work is that of brute force in blocks.

    Rows with a null id or label, with a null or empty vector, or with a null or non-finite component take no part.
    Vectors of different lengths do not meet: each length is searched on its own. Rows that repeat an id, a label and a
    vector count once; an id with several vectors is several rows, none of which is its own partner. Anchors without
    positives, or without rows in their windows, give no rows, and so does an empty table. Scores beyond 64 bits fail
    the job. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stage(_packed(vectors, vec_id, label, embedding, scale), "vectors")
    result = spark.createDataFrame([], SCHEMA)
    for (size,) in rows.select(F.length("vector")).distinct().collect():
        one = rows.filter(F.length("vector") == size)
        found = _mined(one, every, positives, negatives, low_percent, high_percent, seed, (cell_rows, block_rows, anchor_rows))
        result = result.unionByName(found)
    return result


def _mined(
    rows: DataFrame, every: int, positives: int, negatives: int, low: int, high: int, seed: int, sizes: tuple[int, int, int]
) -> DataFrame:
    searcher = _Searcher(rows, seed, *sizes)
    whole = F.array(F.struct(F.lit(0).alias("wid"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high")))
    anchors = rows.filter(F.col("vec_id") % every == 0).withColumn("uid", F.monotonically_increasing_id())
    anchors = stage(anchors.select("uid", "vec_id", "label", "vector", whole.cast(_WINDOWS).alias("windows")), "anchors")
    found = searcher.search(anchors, positives, True)
    by_rank = Window.partitionBy("uid").orderBy(F.desc("score"), "id")
    ranked = found.select("uid", F.row_number().over(by_rank).alias("wid"), "score", "id")
    least, most = -_floor_percent(F.col("score") * -low), _floor_percent(F.col("score") * high)  # a ceiling and a floor
    windows = ranked.select("uid", "wid", "score", "id", least.alias("low"), most.alias("high"))
    windows = stage(windows, "positives")
    asked = windows.filter("low <= high").groupBy("uid").agg(F.collect_list(F.struct("wid", "low", "high")).alias("windows"))
    asked = stage(anchors.drop("windows").join(asked.select("uid", F.col("windows").cast(_WINDOWS)), "uid"), "windows")
    mined = searcher.search(asked.select("uid", "vec_id", "label", "vector", "windows"), negatives, False)
    by_rank = Window.partitionBy("uid", "wid").orderBy(F.desc("score"), "id")
    mined = mined.select("uid", "wid", F.row_number().over(by_rank).alias("rank"), "score", "id")
    own = windows.select("uid", "wid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = mined.join(own, ["uid", "wid"]).join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    return named.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
