"""Language identification: gradients, tables against the plain network, held-out accuracy, and edges."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaloom.llm.language_id import (
    _FOLDED, _PIECE, EPOCHS, WINDOW_BYTES, ByteNetwork, Scorer, held_out, identify_languages, windows_of,
)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, score string, letters int"


def plain(network, window):
    """Log probabilities of one window, filter by filter and place by place."""
    best = []
    for filters in network.filters:
        places = range(WINDOW_BYTES - 3)
        answers = [sum(network.embedding[window[p + k]] @ filters[k] for k in range(len(filters))) for p in places]
        best.append(np.max(answers, axis=0))
    logits = np.maximum(np.concatenate(best) + network.bias, 0) @ network.output + network.offset
    return logits - np.log(np.exp(logits).sum())


@pytest.fixture
def network():
    made = ByteNetwork.fresh(["a", "b", "c"], np.random.default_rng(1))
    made.bias += 0.3
    return made


def test_tables_equal_the_network(network):
    rng = np.random.default_rng(5)
    windows = rng.integers(0, 256, (5, WINDOW_BYTES)).astype(np.uint8)
    windows[3, 40:] = 0
    got = Scorer(network).log_probabilities(windows)
    assert np.allclose(got, [plain(network, w) for w in windows], atol=1e-3)


def test_gradients(network):
    rng = np.random.default_rng(6)
    windows, targets = rng.integers(0, 256, (4, WINDOW_BYTES)).astype(np.uint8), np.array([0, 2, 1, 0])

    def loss():
        return -np.mean([plain(network, w)[t] for w, t in zip(windows, targets)])

    for values, moved in zip(network.parameters(), network.gradients(windows, targets)):
        for at in np.argsort(-np.abs(moved).ravel())[:2]:
            flat, step = values.reshape(-1), 1e-5
            before = flat[at]
            flat[at] = before + step
            above = loss()
            flat[at] = before - step
            below = loss()
            flat[at] = before
            assert abs((above - below) / (2 * step) - moved.reshape(-1)[at]) < 1e-4


def test_windows_cover_whole_texts():
    for n in (0, 1, 252, 253, 254, 255, 256, 257, 509, 510, 2000):
        text = bytes(i % 255 + 1 for i in range(n))
        windows = windows_of(text)
        folded = text.translate(_FOLDED)
        whole = windows[0].tobytes() + b"".join(w[3:].tobytes() for w in windows[1:])
        assert whole[:n] == folded and not any(whole[n:]) and len(windows) == max(1, -(-(n - 3) // 253))


def test_long_texts_are_scored_in_pieces(network):
    text = b"abc def " * (_PIECE // 5) + "été ".encode() * 5000
    scorer = Scorer(network)
    windows = windows_of(text)
    letters = np.array([sum(b >= 0x80 or chr(b).isalpha() for b in w.tobytes()) for w in windows])
    want = (scorer.log_probabilities(windows) * letters[:, None]).sum(axis=0) / letters.sum()
    assert np.allclose(scorer.texts([b"x", text])[1], want, atol=1e-4)


def made(n):
    kinds = {"xx": "abracadabra mala basa ", "yy": "élève où être ", "zz": "straight through though "}
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        lang = list(kinds)[i % 3]
        words = kinds[lang].split()
        rows.append((i, " ".join(rng.choice(words, rng.integers(3, 200))), lang, "s", 1))
    return rows


def test_edges(spark):
    odd = [(900, None, "xx", None, None), (901, "", "xx", None, 1), (902, "12 - 34", "xx", None, 1), (None, "abracadabra", None, "", 1)]
    odd += [(903, "中", None, "", 1), (5, "straight through", "xx", "", 1), (5, "straight through", "xx", "", 1), (904, "mala \x00 basa", "", "", 1)]
    rows = made(600) + odd
    got = identify_languages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is not None, r.doc_id) for r in got) == sorted((r[0] is not None, r[0]) for r in rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (900, 901, 902))
    assert all(0 < r.score <= 1 for r in got if r.lang_pred != "und") and by[903].lang_pred != "und"
    for row in got:
        want = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2
        assert row.held_out == want
    right = [by[i].lang_pred == lang for i, _, lang, _, _ in made(600) if by[i].held_out and i != 5]
    assert sum(right) >= 0.98 * len(right)


def test_nothing_to_learn_from(spark):
    assert identify_languages(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = identify_languages(spark.createDataFrame([(1, "some text", None, "", 1), (2, None, "xx", "", 1)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)] * 2


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    own = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    right = F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))
    found = identify_languages(own).join(own.select("doc_id", "lang"), "doc_id").filter("held_out").agg(right).first()[0]
    assert found >= 0.95 and EPOCHS > 0 and held_out is not None
