"""Substring dedup by difference-cover anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from metaloom.llm.blocks import (
    Asked,
    Block,
    REQUEST_SCHEMA,
    answers,
    buckets_for,
    each_block,
    requests,
    text_blocks,
    trimmed,
    with_answers,
)
from metaloom.llm.words import Words, window_hashes

#: A perfect difference set: any two residues modulo the period meet it at one common shift.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)

SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,length:int>>"
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_text", pa.string()),
        ("removed", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
    ]
)


def _anchors(words: Words, window: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of texts that have a window at all, and their keys."""
    length = window - PERIOD + 1
    if len(words.ids) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = window_hashes(words.hashes(), length)
    ends = words.ends()[: len(hashes)]
    place = np.arange(len(hashes))
    starts = np.repeat(words.starts[:-1], words.lengths)[: len(hashes)]
    covered = np.zeros(PERIOD, bool)
    covered[list(COVER)] = True
    at = np.flatnonzero(covered[(place - starts) % PERIOD] & (place + length <= ends) & (ends - starts >= window))
    return at, trimmed(hashes[at], buckets)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, each one's place among them, and 2 for those seen more than once, else 1."""
    distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return distinct, inverse, np.minimum(counts, 2).astype(np.uint8)


def _spread(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Whether each place is covered by a range of ``size`` from one of ``starts``."""
    steps = np.zeros(total + size + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + size, -1)
    return np.cumsum(steps[:total]) > 0


def remove_repeats(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` without the words that lie in a repeated window.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. A window is ``window`` consecutive words of one row;
    a word goes if some window over it has a word sequence that also starts anywhere else, in any row or the
    same one. Windows are judged on the input. Returns ``doc_id, n_words, n_removed, kept_text`` (kept words
    joined by a space) and ``removed`` (spans of words).

    Method. Two equal windows that start at places ``i`` and ``j`` have a shift below the period at which both
    places are cover positions, so both hash the same anchor there. Anchors that occur once rule out their
    windows. Repeated anchors are extended to all windows that hold them, and those are compared by 128-bit
    hashes of the whole window.

    Null and empty texts have no words and an empty ``kept_text``; null ids stay null; rows that repeat an id or
    a text are rows like any other, so copies of a text lose their windows; an empty table gives no rows; other
    columns are ignored. Blocks bound memory; a very long text is a block of its own.
    """
    if window < PERIOD + 1:
        raise ValueError(f"window must be over {PERIOD}")
    blocks = text_blocks(docs, doc_id=doc_id, text=text)
    buckets = buckets_for(blocks)

    def ask_anchors(block: Block) -> Iterator[pa.RecordBatch]:
        words = Words(t.split() for t in block.texts())
        keys, _, weights = _counted(_anchors(words, window, buckets)[1])
        yield requests(block.block, keys, weights, buckets, trim=True)

    def repeated(table: pa.Table) -> pa.Table:
        asked = Asked(table, np.uint8, trim=True)
        return asked.answer((asked.totals() > 1).astype(np.uint8))

    def ask_windows(block: Block, answer: bytes) -> Iterator[pa.RecordBatch]:
        words = Words(t.split() for t in block.texts())
        at, keys = _anchors(words, window, buckets)
        _, inverse, _ = _counted(keys)
        hit = at[np.frombuffer(answer, np.uint8)[inverse].astype(bool)] if len(at) else at
        whole = len(words.ids) - window + 1
        if whole <= 0 or not len(hit):
            yield requests(block.block, np.empty(0, np.uint64), np.empty(0, np.uint8), buckets)
            return
        near = _spread(np.maximum(hit - PERIOD + 1, 0), PERIOD, whole)
        starts = np.flatnonzero(near & (np.arange(whole) + window <= words.ends()[:whole]))
        first = window_hashes(words.hashes(), window)[starts]
        second = window_hashes(words.hashes(1), window)[starts]
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        firsts = np.flatnonzero(new)
        counts = np.minimum(np.diff(np.append(firsts, len(first))), 2).astype(np.uint8)
        yield requests(block.block, first[firsts], counts, buckets, second[firsts])

    def repeated_windows(table: pa.Table) -> pa.Table:
        asked = Asked(table, np.uint8, wide=True)
        return asked.answer(asked.keys, asked.totals(wide=True) > 1)

    def remove(block: Block, answer: bytes) -> Iterator[pa.RecordBatch]:
        lists = [t.split() for t in block.texts()]
        words = Words(lists)
        gone = np.zeros(len(words.ids), bool)
        known = np.frombuffer(answer, np.uint64)
        if len(known):
            hashes = window_hashes(words.hashes(), window)
            inside = np.arange(len(hashes)) + window <= words.ends()[: len(hashes)]
            starts = np.flatnonzero(inside & np.isin(hashes, known))
            gone = _spread(starts, window, len(gone))
        removed, kept, spans = [], [], []
        for one, a, b in zip(lists, words.starts[:-1], words.starts[1:], strict=True):
            out = gone[a:b]
            removed.append(int(out.sum()))
            edges = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
            pairs = edges.reshape(-1, 2)
            spans.append([{"start": int(s), "length": int(e - s)} for s, e in pairs])
            left, cut = [], 0
            for s, e in pairs:
                left += one[cut:s]
                cut = e
            kept.append(b" ".join(left + one[cut:]).decode())
        for at in range(0, len(lists), 256):
            part = slice(at, at + 256)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids[part], pa.int64()),
                    pa.array(words.lengths[part], pa.int64()),
                    pa.array(removed[part], pa.int64()),
                    pa.array(kept[part], pa.string()),
                    pa.array(spans[part], _OUT.field("removed").type),
                ],
                schema=_OUT,
            )

    anchors = answers(each_block(blocks, ask_anchors, REQUEST_SCHEMA), repeated)
    windows = answers(with_answers(blocks, anchors, ask_windows, REQUEST_SCHEMA), repeated_windows)
    return with_answers(blocks, windows, remove, SCHEMA)
