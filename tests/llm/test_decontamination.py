"""Benchmark decontamination against a plain search for every window."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from metaloom.llm.decontamination import ItemAutomaton, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    """Hit words and ids of items with a window in the text."""
    own, hit, ids = words(text), set(), set()
    for key, item in items:
        sought = words(item)
        size = min(window, len(sought))
        windows = {tuple(sought[i : i + size]) for i in range(len(sought) - size + 1)} if size else set()
        for i in range(len(own) - size + 1):
            if size and tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                ids.add(key)
    return len(own), hit, sorted(i for i in ids if i is not None)


def texts(seed, n, letters, longest):
    rng = random.Random(seed)
    marks = [" ", ", ", "\n", "-", ". ", "…"]
    return ["".join(rng.choice(letters) + rng.choice(marks) for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("seed, letters, shards", [(1, "ab", 10**6), (2, "abcd", 60), (3, ["a", "B", "é", "中文", "x1"], 10**6)])
def test_against_every_window(spark, seed, letters, shards):
    items = [(f"i{i}", t) for i, t in enumerate(texts(seed, 25, letters, 30))]
    items += [(None, "a b a b a"), ("i0", "b b"), ("n", None), ("e", "...")]
    docs = [(i, t, 0) for i, t in enumerate(texts(seed + 50, 60, letters, 120))]
    docs += [(None, docs[0][1], 0), (3, None, None), (4, "", 0), (5, docs[5][1], 0), (900, " ".join(t for _, t in items if t), 0)]
    found = decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string, spans int"),
        spark.createDataFrame(items, "item_id string, text string"),
        automaton_words=shards,
    ).collect()
    got = sorted(
        (r.doc_id or -1, r.text or "", r.n_words, tuple(x for s in r.spans for x in range(s.start, s.start + s.length)), tuple(r.item_ids))
        for r in found
    )
    want = []
    for key, text, _ in docs:
        n, hit, ids = brute(text, items)
        want.append((key or -1, text or "", n, tuple(sorted(hit)), tuple(ids)))
    assert got == sorted(want)
    for r in found:
        assert not brute(r.clean_text, items)[1]


def test_repeated_words_take_linear_time():
    def seconds(n):
        one = [b"la"] * n
        start = time.process_time()
        automaton = ItemAutomaton([(one, frozenset({"i"}))], 10, 1.0)
        longest, runs, items = automaton.match(one)
        assert (longest, runs, items) == (n, [[0, n]], {"i"})
        return time.process_time() - start

    seconds(1000)
    assert seconds(40_000) < 40 * max(seconds(4_000), 0.02)


def test_digest_of_ids(spark):
    docs = spark.createDataFrame([(1, "a b c x y")], "doc_id long, text string")
    items = spark.createDataFrame([("10", "x y"), ("9", "a b c")], "item_id string, text string")
    found = decontaminate(docs, items).select(F.sha2(F.concat_ws(",", "item_ids"), 256)).first()[0]
    assert found == hashlib.sha256(b"10,9").hexdigest()
