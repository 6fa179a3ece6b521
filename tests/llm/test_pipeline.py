"""Every stage of the pipeline against a plain version of what it does."""

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from metaloom.llm.packing import pack_documents
from metaloom.llm.queries import tokenizer_path
from metaloom.session import staging_path
from tests.llm.test_decontamination import brute as contaminated

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


def folder(spark, **tables):
    path = staging_path(spark, "tables")
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path


def groups(texts):
    """Classes of near duplicates by comparing all pairs."""
    sets = []
    for text in texts:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(texts)):
        out[find(i)].append(i)
    return list(out.values())


def chained(rng):
    """Texts of which each is near the one before only, so that a group is a chain of links."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(130)]
    for step in range(8):
        yield " ".join(words[step * 3 : step * 3 + 60])


def test_one_of_each_group_stays(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"x{rng.randrange(400)}" for _ in range(rng.randrange(3, 60)))) for i in range(40)]
    rows += [(100 + i, t) for i, t in enumerate(chained(rng))] + [(200 + i, t) for i, t in enumerate(chained(rng))]
    rows += [(300, rows[3][1]), (3, rows[3][1]), (3, rows[4][1] + " tail"), (5, rows[7][1]), (5, "a text of its own here, and long")]
    rows += [(None, rows[9][1]), (None, "nobody knows my name but me"), (400, None), (401, None), (402, ""), (403, " \n")]
    kept = pipeline.near_duplicate(spark, frame(spark, rows), "").collect()
    left = [(r.doc_id, r.text) for r in kept]
    for own in groups([t for _, t in rows]):
        members = {rows[i] for i in own}
        stayed = [r for r in left if r in members]
        blank = not (rows[own[0]][1] or "").split()
        assert len(stayed) == 1 or blank and len(members) == 1, members
    assert set(left) <= set(rows) and kept[0].asDict().keys() == set(pipeline.COLUMNS)


def test_benchmark_passages_go(spark):
    rng = random.Random(6)
    items = [(f"i{i}", " ".join(rng.choice("abcde") * 2 for _ in range(rng.randrange(4, 30)))) for i in range(12)]
    rows = [(i, " ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(0, 80)))) for i in range(60)]
    rows += [(100, items[3][1]), (101, f"Before, {items[3][1].upper()}! After."), (102, None), (103, "")]
    path = folder(spark, benchmark=spark.createDataFrame(items, "item_id string, text string"))
    left = {r.doc_id: r for r in pipeline.decontamination(spark, frame(spark, rows), path).collect()}
    for key, text in rows:
        hit = contaminated(text, items)[1]
        if not hit:
            assert left[key].text == text and left[key].n_chars == (None if text is None else len(text))
        elif key in left:
            assert not contaminated(left[key].text, items)[1] and left[key].n_chars == len(left[key].text)
    assert 100 not in left and left[101].text == "Before, ! After."


def test_private_data_goes(spark):
    rows = [(1, "write to ann@example.org now"), (2, "nothing here"), (3, None), (4, "ann@example.org"), (5, "4 plain 5 numbers")]
    left = {r.doc_id: r for r in pipeline.private_data(spark, frame(spark, rows), "").collect()}
    assert set(left) == {1, 2, 3, 4, 5} and "ann" not in left[1].text and left[1].text.split()[2] == left[4].text
    assert [left[i].text for i in (2, 3, 5)] == [t for i, t in rows if i in (2, 3, 5)]
    assert left[1].n_chars == len(left[1].text) and left[3].n_chars is None


def test_sequences_hold_all_tokens(spark):
    rng = random.Random(9)
    odd = ["", None, " ", "Zażółć gęślą jaźń …", "ﬁne ² ½ ǅ", "éé İI", "a" * 500, "词 " * 900, "\x00\x01", "x.y,z!!"]
    rows = list(enumerate(odd)) + [(100 + i, " ".join(f"Word{rng.randrange(50)}," for _ in range(rng.randrange(1, 3000)))) for i in range(40)]
    rows += [(7, "the same id again"), (None, "no id at all")]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = sorted((i if i is not None else -1, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows)
    pieces = pack_documents(frame(spark, rows), tokenizer_path()).collect()
    expected = []
    for key, ids in want:
        for n, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.append((key, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in pieces)
    assert got == sorted(expected)
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048
    total = sum(r.length for r in pieces)
    assert len(sequences) <= 1.1 * np.ceil(total / 2048) + 1


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_quality_and_the_whole(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = pipeline.quality(spark, docs, SF_DIR)
    assert kept.columns == list(pipeline.COLUMNS)
    before, left = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in kept.collect()}
    assert all(left[i].text == before[i].text for i in left)
    good = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(i in left for i in good) >= 0.95 * len(good) and len(left) < len(before)
    packed = pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} <= set(left)
