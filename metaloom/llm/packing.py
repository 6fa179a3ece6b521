"""Best-fit packing with bound-certified repacking."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metaloom.llm.blocks import held, let_go, slices
from metaloom.session import stage

#: Pieces that one task packs.
PARTITION_PIECES = 20_000
#: Words whose ids a worker remembers, in about 200 bytes each.
CACHED_WORDS = 1_100_000
#: Marks, of which those that close a word after a letter or digit are words for themselves.
_MARKS = bytes([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
#: Rounds of exchange between partitions whose bin count is above its bound.
ROUNDS = 3

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
PACKED = PIECES + ", bin long, offset long, closed boolean"


class WordTokenizer:
    """Token ids of whole texts, through ids of their words.

    The tokenizer drops white space and never joins characters across it, so the ids of a text are those of its words
    one after the other. New words are encoded many at a time, as a text cut into words, and remembered. Words with
    closing marks, which the tokenizer takes for themselves, are remembered as well, but not encoded: a rare word comes
    with many of them.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit numbers."""
        lists = [(t if b"<|" in t else t.lower()).split() for t in texts]  # as the tokenizer does, but for special strings
        known = self.known
        new = set().union(*lists).difference(known)
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = set().union(*lists)
        parts = {word: own for word in new if (own := self._parts(word))}
        encoded = new.difference(parts).union(*parts.values())
        self._learn(list(encoded.difference(known)))
        known.update((word, known[body] + known[marks]) for word, (body, marks) in parts.items())
        return [b"".join(map(known.__getitem__, words)) for words in lists]

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes] | None:
        """A word and the marks that close it; none where there are no such marks, or may be a special string."""
        body = word.rstrip(_MARKS)
        if len(body) == len(word) or not body or body[-1] not in _LETTERS or b"<|" in word:
            return None
        return body, word[len(body) :]

    def _learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            encoded = self.tokenizer.encode(
                [w.decode() for w in some], is_pretokenized=True, add_special_tokens=False
            )
            data = np.array(encoded.ids, "<u4").tobytes()
            cuts = np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(len(some) + 1)) * 4
            ends = cuts.tolist()
            self.known.update((w, data[a:b]) for w, a, b in zip(some, ends[:-1], ends[1:], strict=True))


def token_pieces(
    docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document's ids and an end id, cut into pieces of ``size`` where longer; written to the shared folder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = held((WordTokenizer, tokenizer_path), lambda: WordTokenizer(tokenizer_path))
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                for key, ids in zip(part.column(0).to_pylist(), tokenizer.ids(texts), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * size)):
                        one = ids[start : start + 4 * size]
                        rows.append((number, key, piece, start // 4, len(one) // 4, zlib.crc32(one)))
                        number += 1
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES
                )

    columns = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return stage(columns.mapInArrow(cut, PIECES), "pieces")


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length: longest first, into the fullest bin with room (the latest made of those)."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, made = 0, 0  # bit r of rooms: some bin has r free
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, own, made = size, made, made + 1
        bins[i], offsets[i] = own, size - room
        if room > length:
            with_room[room - length].append(own)
            rooms |= 1 << (room - length)
    return bins, offsets


def bin_bound(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs: the largest bound by dual feasible functions.

    ``f(x) = 0 if x < k, size if x > size - k, else x`` for each k up to half the size (k = 0 is the sum of
    lengths), and ``f(x) = floor((p + 1) x / size)`` rounded as Fekete and Schepers do, for small p.
    """
    counts = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    values = np.arange(size + 1, dtype=np.int64)
    up, weight = np.cumsum(counts[::-1])[::-1], np.cumsum(counts * values)
    k = np.arange(size // 2 + 1)
    above = np.where(k > 0, up[np.minimum(size - k + 1, size)], 0)
    middle = weight[size - k] - np.where(k > 0, weight[np.maximum(k - 1, 0)], 0)
    best = int(np.max(-(-(above * size + middle) // size), initial=0))
    for p in range(1, 21):
        scaled = (p + 1) * values
        steps = np.where(scaled % size == 0, values * p, size * (scaled // size))  # in units of 1 / (p * size)
        best = max(best, math.ceil(int((steps * counts).sum()) / (p * size)))
    return best


def pack(pieces: DataFrame, size: int = 2048, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: a packing into as few sequences of ``size`` as found.

    Partitions of pieces are packed by best-fit decreasing. One whose number of bins equals its bound is certified
    and stays. The others keep their full bins, hand the pieces of bins with gaps to each other and pack again.
    """
    count = pieces.count()
    parts = max(1, math.ceil(count / partition_pieces))

    def task(turn: int):
        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            let_go()  # all is tokenized
            lengths = frame["length"].to_numpy()
            bins, offsets = best_fit_decreasing(lengths, size)
            used = np.bincount(bins, weights=lengths, minlength=1)
            certified = len(used) == bin_bound(lengths, size)
            last = turn == ROUNDS - 1 or parts == 1
            closed = np.full(len(frame), True) if certified or last else used[bins] == size
            # sequence numbers: turn, then partition, then bin
            number = ((turn << 24) + int(key[0]) << 24) + bins
            return frame.drop(columns="part").assign(bin=number, offset=offsets, closed=closed)

        return run

    done, rest = None, pieces
    for turn in range(ROUNDS):
        dealt = rest.withColumn("part", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(max(1, parts))))
        packed = dealt.groupBy("part").applyInPandas(task(turn), PACKED)
        packed = stage(packed, "packed")
        closed = packed.filter("closed").drop("closed")
        done = closed if done is None else done.unionByName(closed)
        rest = packed.filter("NOT closed").select(*pieces.columns)
        if turn < ROUNDS - 1:
            left = rest.count()
            if not left:
                break
            parts = max(1, math.ceil(left / partition_pieces))
    return done.withColumnRenamed("bin", "sequence_id").drop("row")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All documents as pieces of at most ``size`` tokens, packed into as few sequences of ``size`` as found.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A null or empty text is one piece of
    the end id alone; null ids stay null; repeated rows are packed each; an empty table gives no rows; other columns
    are ignored. A very long text is tokenized whole and cut afterwards.
    """
    return pack(token_pieces(docs, tokenizer_path, size, end_id, doc_id, text), size)
