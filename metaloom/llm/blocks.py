"""Texts in blocks, and a keyed exchange between blocks.

A block is one row that holds a few megabytes of whole texts, compressed. Operators that need to know
of each n-gram how often it occurs anywhere work in two steps. Each block sends its distinct n-gram
hashes, sorted and cut by hash range into buckets (``requests``); each bucket merges what it got and
answers every block in the order asked (``answers``). Against one row per n-gram this moves a third of
the bytes, and a key that is everywhere arrives at its bucket once per block instead of once per
occurrence: no key, source or group of copies makes a bucket larger than its range of hashes.

Blocks are written to the shared folder once, so both steps see the same blocks when tasks are redone.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from metaloom.session import staging_path

#: Text bytes of a block. A longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Text bytes, over all blocks, for each bucket.
BUCKET_BYTES = 16 << 20
#: Blocks in one file, which bounds what a columnar reader holds at once.
BLOCKS_PER_FILE = 16

BLOCK_SCHEMA = "block long, part int, ids array<long>, lengths array<int>, size long, data binary"
REQUEST_SCHEMA = "block long, bucket int, keys binary, weights binary"
ANSWER_SCHEMA = "block long, bucket int, answer binary"

_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("size", pa.int64()),
        ("data", pa.binary()),
    ]
)
_REQUEST = pa.schema(
    [("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("weights", pa.binary())]
)
_ANSWER = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary())])


def text_blocks(
    docs: DataFrame,
    part_of: Callable[[int | None], int] = lambda _: 0,
    block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row of ``docs`` in some block; written to the shared folder and read back.

    ``part_of`` deals documents by id to parts from 0 to 255, and a block has documents of one part
    only, which its number ends in. Null ids and null texts are kept. Other columns are dropped.
    """
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        made = context.partitionId() << 24
        squeeze = zstandard.ZstdCompressor(level=3)
        open_blocks: dict[int, tuple[list, list, list]] = {}
        sizes: dict[int, int] = {}

        def close(part: int) -> pa.RecordBatch:
            nonlocal made
            ids, lengths, texts = open_blocks.pop(part)
            made += 1
            row = {
                "block": [made << 8 | part],
                "part": [part],
                "ids": [ids],
                "lengths": [lengths],
                "size": [sizes.pop(part)],
                "data": [squeeze.compress(b"".join(texts))],
            }
            return pa.RecordBatch.from_pydict(row, _BLOCK)

        for batch in batches:
            for rows in slices(batch, 1):
                values = rows.column(1).cast(pa.binary()).to_pylist()
                for key, value in zip(rows.column(0).to_pylist(), values, strict=True):
                    part = part_of(key)
                    size = len(value or b"")
                    if part in open_blocks and sizes[part] + size > block_bytes:
                        yield close(part)
                    ids, lengths, texts = open_blocks.setdefault(part, ([], [], []))
                    ids.append(key)
                    lengths.append(-1 if value is None else size)
                    texts.append(value or b"")
                    sizes[part] = sizes.get(part, 0) + size
        for part in list(open_blocks):
            yield close(part)

    columns = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    path = staging_path(spark, "blocks")
    writer = columns.mapInArrow(cut, BLOCK_SCHEMA).write.option("compression", "none")
    writer.option("maxRecordsPerFile", BLOCKS_PER_FILE).parquet(path)
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def of_part(rows: DataFrame, part: int) -> DataFrame:
    """The blocks, or answers to blocks, of one part."""
    return rows.filter(F.col("block").bitwiseAND(F.lit(255)) == part)


def return_memory() -> None:
    """Give what a worker has freed back to the system, as executors are held to what they and their workers hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


_held: dict[object, object] = {}


def held(key: object, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept by a worker for its next tasks; a worker keeps one such object at a time."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Free what a worker keeps for tasks of another kind, before it needs the memory itself."""
    _held.clear()
    return_memory()


def slices(batch: pa.RecordBatch, column: int, size: int = 2 << 20, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``size`` bytes in a text column at most, or one longer row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = int(np.searchsorted(ends, before + size, side="right"))
        upto = min(max(upto, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, upto - at)
        return_memory()
        at = upto


class Block:
    """A block's rows, read from its row of a table."""

    def __init__(self, table: pa.Table | pa.RecordBatch, row: int = 0):
        self.block = table.column("block")[row].as_py()
        self.part = table.column("part")[row].as_py()
        self.ids: list[int | None] = table.column("ids")[row].as_py()
        self._lengths: list[int] = table.column("lengths")[row].as_py()
        size = table.column("size")[row].as_py()
        data = table.column("data")[row].as_py()
        self._data = zstandard.ZstdDecompressor().decompress(data, max_output_size=size) if size else b""

    def texts(self) -> Iterator[bytes]:
        """Whole texts in order; empty for null."""
        at = 0
        for length in self._lengths:
            yield self._data[at : at + max(length, 0)]
            at += max(length, 0)


def each_block(blocks: DataFrame, work: Callable[[Block], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on every block by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from work(Block(batch, row))
                return_memory()

    return blocks.mapInArrow(run, schema)


def buckets_for(blocks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets the blocks' keys go to: in proportion to the text, two at least."""
    total = blocks.agg(F.sum("size")).first()[0] or 0
    return max(2, math.ceil(total / bucket_bytes))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of 64-bit keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _spare(buckets: int) -> np.uint64:
    """Low bits of keys without which 40 bits tell keys of one bucket apart."""
    return np.uint64(max(0, 24 - (buckets.bit_length() - 1)))


def trimmed(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Keys without spare bits, for filters that bear a rare false match; equal keys stay equal."""
    return keys >> _spare(buckets) << _spare(buckets)


def requests(
    block: int,
    keys: np.ndarray,
    weights: np.ndarray | None,
    buckets: int,
    more: np.ndarray | None = None,
    trim: bool = False,
) -> pa.RecordBatch:
    """One row for each bucket: its part of sorted, distinct ``keys``, with ``more`` key bits and weights.

    Keys that were ``trimmed`` take five bytes: the lower four of all keys, then the fifth, which sorted keys share.
    """

    def encode(part: np.ndarray) -> bytes:
        if not trim:
            return part.tobytes()
        short = part >> _spare(buckets)
        return short.astype(np.uint32).tobytes() + (short >> np.uint64(32)).astype(np.uint8).tobytes()

    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    rows = [(b, slice(cuts[b], cuts[b + 1])) for b in range(buckets) if cuts[b] < cuts[b + 1]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(rows), pa.int64()),
            pa.array([b for b, _ in rows], pa.int32()),
            pa.array([encode(keys[s]) + (b"" if more is None else more[s].tobytes()) for _, s in rows], pa.binary()),
            pa.array([None if weights is None else weights[s].tobytes() for _, s in rows], pa.binary()),
        ],
        schema=_REQUEST,
    )


class Asked:
    """What one bucket was asked, in the order of its rows."""

    def __init__(self, table: pa.Table, weight_type, wide: bool = False, trim: bool = False):
        self.blocks = table.column("block").to_pylist()
        self.bucket = table.column("bucket")[0].as_py()
        pieces = [self._decode(x) if trim else np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
        if wide:
            self.more = np.concatenate([p[len(p) // 2 :] for p in pieces])
            pieces = [p[: len(p) // 2] for p in pieces]
        self.keys = np.concatenate(pieces)
        self.weights = np.concatenate([np.frombuffer(x, weight_type) for x in table.column("weights").to_pylist()])
        self.cuts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    @staticmethod
    def _decode(data: bytes) -> np.ndarray:
        low, high = np.frombuffer(data, np.uint32, len(data) // 5), np.frombuffer(data, np.uint8)[len(data) // 5 * 4 :]
        return low | high.astype(np.uint64) << np.uint64(32)

    def totals(self, wide: bool = False) -> np.ndarray:
        """For each entry, the sum of weights of all entries with its key."""
        order = np.lexsort((self.more, self.keys)) if wide else np.argsort(self.keys, kind="stable")
        keys = self.keys[order]
        new = np.empty(len(keys), bool)
        new[:1] = True
        np.not_equal(keys[1:], keys[:-1], out=new[1:])
        if wide:
            more = self.more[order]
            new[1:] |= more[1:] != more[:-1]
        firsts = np.flatnonzero(new)
        sums = np.add.reduceat(self.weights[order].astype(np.int64), firsts)
        totals = np.empty(len(keys), np.int64)
        totals[order] = np.repeat(sums, np.diff(np.append(firsts, len(keys))))
        return totals

    def answer(self, values: np.ndarray, keep: np.ndarray | None = None) -> pa.Table:
        """``values`` of each block's entries (of those to ``keep``), as bytes."""
        parts = zip(self.cuts[:-1], self.cuts[1:], strict=True)
        out = [(values[a:b] if keep is None else values[a:b][keep[a:b]]).tobytes() for a, b in parts]
        return pa.Table.from_arrays(
            [
                pa.array(self.blocks, pa.int64()),
                pa.array([self.bucket] * len(out), pa.int32()),
                pa.array(out, pa.binary()),
            ],
            schema=_ANSWER,
        )


def answers(asked: DataFrame, reply: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``reply`` on all requests of each bucket."""

    def run(table: pa.Table) -> pa.Table:
        return_memory()
        return reply(table)

    return asked.groupBy("bucket").applyInArrow(run, ANSWER_SCHEMA)


def with_answers(
    blocks: DataFrame, replies: DataFrame, work: Callable[[Block, bytes], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``work`` on every block with its answers, joined in the order of buckets."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return_memory()
        order = np.argsort(right.column("bucket").to_numpy(), kind="stable")
        parts = right.column("answer").to_pylist()
        made = list(work(Block(left), b"".join(parts[i] for i in order)))
        return pa.Table.from_batches(made)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)
