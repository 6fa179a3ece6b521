"""Benchmark decontamination with a generalised suffix automaton of the items."""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metaloom.llm.blocks import slices
from metaloom.llm.words import text_words
from metaloom.session import stage

#: Benchmark words that one automaton holds, and so the bound of what is broadcast at a time.
AUTOMATON_WORDS = 200_000

_WORD = re.compile(rb"[0-9a-zA-Z\x80-\xff]+")
_SPAN = "struct<start:int,length:int>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))


class ItemAutomaton:
    """The suffix automaton of several word sequences, with the windows of each marked on their states.

    An item's window is as long as its limit: ``window`` words, or the given share of the item if that is less.
    ``step`` follows one word and keeps the longest suffix of the words read so far that occurs in any item.
    """

    def __init__(self, items: list[tuple[list[bytes], frozenset[str]]], window: int, coverage: float):
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        codes = [[self.words.setdefault(w, len(self.words) + 1) for w in words] for words, _ in items]
        for one in codes:
            last = 0
            for code in one:
                last = self._extend(last, code)
        limits = [max(1, min(window, math.ceil(coverage * len(one)))) for one in codes]
        self.shortest = min(limits, default=window)
        marked: defaultdict[int, dict[int, set[str]]] = defaultdict(dict)
        for one, limit, (_, ids) in zip(codes, limits, items, strict=True):
            state = 0
            for place, code in enumerate(one):
                state = self.next[state][code]
                while self.length[self.link[state]] >= limit:
                    state = self.link[state]
                if place + 1 >= limit:
                    marked[state].setdefault(limit, set()).update(ids)
        self.marked = dict(marked)
        # windows marked on the states that suffix links lead to are shorter than any match in a state, so they are all
        # there: each state has the widest of them, and the nearest state that has any
        self.above, self.up = [0] * len(self.next), [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            to = self.link[state]
            own = self.marked.get(to)
            self.above[state] = max(self.above[to], max(own)) if own else self.above[to]
            self.up[state] = to if own else self.up[to]

    def _extend(self, last: int, code: int) -> int:
        """The state of the item's prefix that ends with ``code``; ``last`` is that of the prefix before."""
        known = self.next[last].get(code)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, code, known)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and code not in self.next[at]:
            self.next[at][code] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            known = self.next[at][code]
            self.link[new] = known if self.length[known] == self.length[at] + 1 else self._split(at, code, known)
        return new

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, at: int, code: int, old: int) -> int:
        """A state for those words of ``old`` that also end where ``at`` followed by ``code`` does."""
        short = self._state(self.length[at] + 1, dict(self.next[old]))
        self.link[short], self.link[old] = self.link[old], short
        while at >= 0 and self.next[at].get(code) == old:
            self.next[at][code] = short
            at = self.link[at]
        return short

    def match(self, words: list[bytes]) -> tuple[int, list[list[int]], set[str]]:
        """The longest match, the maximal runs ``[start, end)`` of hit words, and the items with a window here."""
        longest, runs, items = 0, [], set()
        codes = list(map(self.words.get, words))
        if not any(codes):
            return longest, runs, items
        following, link, length, marked = self.next, self.link, self.length, self.marked
        state = matched = 0
        listed: set[int] = set()  # states whose items, and those of the states above, are known to be here
        for place, code in enumerate(codes):
            if code is None:
                state = matched = 0
                continue
            while state and code not in following[state]:
                state = link[state]
                matched = length[state]
            state = following[state].get(code, 0)
            matched = matched + 1 if state else 0
            if matched > longest:
                longest = matched
            if matched >= self.shortest:
                widest = self.above[state]
                if own := marked.get(state):
                    fitting = [limit for limit in own if limit <= matched]
                    widest = max(fitting, default=widest)
                    if state not in listed:
                        items.update(*(own[limit] for limit in fitting))
                        if len(fitting) == len(own):
                            listed.add(state)
                at = self.up[state]
                while at and at not in listed:
                    items.update(*marked[at].values())
                    listed.add(at)
                    at = self.up[at]
                if widest:
                    start = place + 1 - widest
                    while runs and start <= runs[-1][1]:
                        start = min(start, runs.pop()[0])
                    runs.append([start, place + 1])
        return longest, runs, items


def _without(text: bytes, runs: list[list[int]]) -> bytes:
    """The text without the characters from the first to the last word of each run."""
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for start, end in runs:
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]])


def _merged(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    coverage: float = 1.0,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    automaton_words: int = AUTOMATON_WORDS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every row of ``docs`` with the words it shares with benchmark items, and its text without them.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. Words that match ``window``
    consecutive words of an item are hit, or fewer where they already cover the share ``coverage`` of the item
    (1.0: all of a short item). Returns ``doc_id, text, n_words, longest`` (longest match in words), ``spans``
    (maximal runs of hit words), ``item_ids`` (sorted ids, as text, of items hit) and ``clean_text``: the text
    without the spans, taken again until none is left. Columns to ``carry`` along come as one struct, ``carried``.

    Items go into one suffix automaton, which is broadcast. A benchmark of over ``automaton_words`` words is dealt by
    hash to several of about that size, used one after the other on rows written in between, until a round of all of
    them takes nothing away.

    Null and empty texts have no words and stay as they are; items without words hit nothing; items with a null id
    hit words but are not listed; equal items are all listed, a repeated id once; rows of ``docs`` that repeat are
    rows like any other. Empty tables give no rows or no hits. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    items = items.withColumn("size", F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))
    total = items.agg(F.sum("size")).first()[0] or 0
    shards = max(1, math.ceil(total / automaton_words))
    items = items.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.lit(None).cast("long").alias("n_words"),
        F.lit(0).alias("longest"),
        F.expr(f"cast(array() AS array<{_SPAN}>)").alias("spans"),
        F.expr("cast(array() AS array<string>)").alias("item_ids"),
        F.col(text).cast("string").alias("clean_text"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    schema = rows.schema
    left = None
    for shard in itertools.cycle(range(shards)):
        gathered: defaultdict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for row in items.filter(F.col("shard") == shard).toLocalIterator():
            if words := tuple(text_words((row["text"] or "").encode())):
                gathered[words].update([] if row["id"] is None else [row["id"]])
        sequences = [(list(words), frozenset(ids)) for words, ids in sorted(gathered.items())]
        automaton = spark.sparkContext.broadcast(ItemAutomaton(sequences, window, coverage))

        def match(batches: Iterator[pa.RecordBatch], automaton=automaton) -> Iterator[pa.RecordBatch]:
            found = automaton.value
            for batch in batches:
                for part in slices(batch, 1):
                    old = zip(*(part.column(i).to_pylist() for i in (3, 4, 5)), strict=True)
                    texts = part.column(1).cast(pa.binary()).to_pylist()
                    cleans = part.column(6)
                    clean, n_words, longest, spans, ids = cleans.cast(pa.binary()).to_pylist(), [], [], [], []
                    for i, (one, (before, runs, known)) in enumerate(zip(texts, old, strict=True)):
                        words = text_words(one or b"")
                        most, hit, items = found.match(words)
                        n_words.append(len(words))
                        longest.append(max(before, most))
                        runs = _merged([[r["start"], r["start"] + r["length"]] for r in runs] + hit)
                        spans.append([{"start": a, "length": b - a} for a, b in runs])
                        ids.append(sorted(items.union(known)))
                        while clean[i] and (hit or clean[i] != one):
                            hit = found.match(text_words(clean[i]))[1]
                            if not hit:
                                break
                            clean[i] = _without(clean[i], hit)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            part.column(1),
                            pa.array(n_words, pa.int64()),
                            pa.array(longest, pa.int32()),
                            pa.array(spans, _SPANS),
                            pa.array(ids, pa.list_(pa.string())),
                            pa.array(clean, pa.binary()).cast(pa.string()),
                            *part.columns[7:],
                        ],
                        names=part.schema.names,
                    )

        rows = rows.mapInArrow(match, schema)
        if shards == 1:
            return rows
        rows = stage(rows, "decontaminated")
        if shard == shards - 1:  # what one automaton takes away may join words to a window of an earlier one
            before, left = left, rows.agg(F.sum(F.length("clean_text"))).first()[0]
            if left == before:
                return rows
