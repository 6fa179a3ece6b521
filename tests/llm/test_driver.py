"""What the driver gets and plans: little, and none of what executors can keep."""

import numpy as np

from metaloom.llm import quality_resampling as qr
from metaloom.llm.components import components
from metaloom.llm.quality_resampling import ALL, FEATURES, LOW, PAIRS, TARGET, TOXIC, fit_models

TEXTS = [f"Alpha beta b{i % 7} Gamma gamma, ugly{i % 5} {'X' * (i % 4)} end." for i in range(60)]


def test_a_star_is_known_by_one_count(spark, monkeypatch):
    links = spark.createDataFrame([(1, n) for n in range(2, 30)], "a long, b long").coalesce(1)
    counted, plain = [], type(links).count
    monkeypatch.setattr(type(links), "count", lambda self: (counted.append(self), plain(self))[1])
    found = components(links)
    assert len(counted) == 1
    assert sorted(map(tuple, found.collect())) == [(n, 1) for n in range(1, 30)]


def test_components_of_chains_and_circles(spark):
    links = [(n, n + 1) for n in range(0, 40)] + [(60, 50), (55, 60), (50, 55), (70, 70), (None, 3), (81, 80), (81, 80)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    wanted = {n: 0 for n in range(41)} | {50: 50, 55: 50, 60: 50, 80: 80, 81: 80}
    assert len(found) == len(wanted) and {r.node: r.root for r in found} == wanted


def test_models_are_made_of_counts_that_stay_on_executors(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    ids, kinds = np.arange(60), np.array([(TARGET, LOW, TOXIC)[i % 3] for i in range(60)], np.int8)
    sent, plain = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda self: (sent.append(plain(self)), sent[-1])[1])
    models = fit_models(docs, ids, kinds)
    assert sum(t.nbytes for t in sent) <= 13 * sum(t.num_rows for t in sent)

    known = ids[qr._fits(ids)]
    total, pairs = np.zeros((4, qr._PAIRS_AT)), np.zeros((3, PAIRS))
    features = qr._Features([t.encode() for t in TEXTS])
    features.count(total[ALL])
    own = qr._classes(list(range(60)), known, kinds[qr._fits(ids)])
    for kind in (TARGET, LOW, TOXIC):
        features.count(total[kind], own == kind, pairs[kind])
    at = 0
    for model, (size, against) in zip(models, ((FEATURES, TOXIC), (FEATURES, TOXIC), (FEATURES, LOW), (2, LOW))):
        part = total[:, at : at + size]
        at += size
        corpus = (part[ALL] + 0.5) / (part[ALL].sum() + 0.5 * size)
        prior = max(1.0, part[[TARGET, LOW, TOXIC]].sum(axis=1).min())
        target, raw = ((part[c] + prior * corpus) / (part[c].sum() + prior) for c in (TARGET, against))
        assert (model == np.log(target / raw).astype(np.float32)).all()
    target, raw = ((pairs[c] + 1) / (pairs[c].sum() + PAIRS) for c in (TARGET, TOXIC))
    assert (models[-1] == np.append(np.log(target / raw), 0).astype(np.float32)).all()
