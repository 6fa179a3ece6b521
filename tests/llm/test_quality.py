"""Importance resampling: models and top-k against plain versions, phrases, missing classes."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaloom.llm.quality_resampling import NO_STRATUM, PAIRS, Resampler, _Features, _fits, _noise, threshold

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def made(n=600, toxic=lambda w, i: w):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randrange(20, 70))]
        bad = i % 4 == 0
        own[10:10] = ["red", "fox"] if bad else [("red", "fox")[i % 2]]
        docs.append((i, " ".join(own), "en"))
        labels.append((i, 1, int(bad)))
    return docs, labels


def resampler(spark, docs, labels, **options):
    return Resampler(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), **options)


def test_phrases_of_ordinary_words(spark):
    docs, labels = made()
    chosen = {r.doc_id for r in resampler(spark, docs, labels).weights().filter("selected").collect()}
    assert not any(i % 4 == 0 for i in chosen) and len(chosen) >= 0.98 * 450


def test_pair_model(spark):
    """The weight of a pair is the log ratio of its add-one estimates."""
    docs, labels = made(200)
    model = resampler(spark, docs, labels).models.value[-1]
    fitted = _fits(np.array([d[0] for d in docs]))
    counts = [Counter(), Counter()]
    for (i, text, _), fits in zip(docs, fitted, strict=True):
        own = text.split()
        if fits:
            counts[i % 4 == 0].update(zip(own, own[1:]))
    sums = [sum(c.values()) for c in counts]
    place = {p: int(_Features([" ".join(p).encode()]).pair[1]) for p in {*counts[0], *counts[1], ("never", "seen")}}
    hashed = [Counter(), Counter()]
    for c, h in zip(counts, hashed):
        for pair, n in c.items():
            h[place[pair]] += n
    assert len(set(place.values())) > 0.97 * len(place)
    for pair in [("red", "fox"), *list(counts[0])[:40], ("never", "seen")]:
        at = place[pair]
        target, raw = ((h[at] + 1) / (n + PAIRS) for h, n in zip(hashed, sums))
        assert model[at] == pytest.approx(math.log(target / raw), abs=1e-4)
    assert model[PAIRS] == 0


@pytest.mark.parametrize("keep", [0, 1, 10, 137, 599, 600, 1000])
@pytest.mark.parametrize("kinds", ["all", "good", "none"])
def test_exactly_as_many_as_asked(spark, keep, kinds):
    docs, labels = made()
    labels = {"all": labels, "good": [(i, 1, 0) for i in range(300)], "none": []}[kinds]
    rows = resampler(spark, docs, labels, keep=keep).weights().collect()
    by_key = sorted(rows, key=lambda r: -r.key)
    assert {r.doc_id for r in rows if r.selected} == {r.doc_id for r in by_key[:keep]}
    assert all(math.isfinite(r.log_weight) and math.isfinite(r.key) for r in rows)


def test_ties_are_selected_with_the_last(spark):
    docs = [(i // 3, "same text", "en") for i in range(30)]
    rows = resampler(spark, docs, [], keep=4).weights().collect()
    assert sum(r.selected for r in rows) == 6
    assert {r.doc_id: r.key - r.log_weight * 10 for r in rows}[3] == pytest.approx(_noise([3], np.uint64(0))[0], abs=1e-6)


def test_thresholds():
    good, bad = np.array([1.0, 2.0, 3.0, -5.0]), np.array([-9.0, -8.0, 1.5])
    assert threshold(good, bad) == -6.5 and threshold(good, bad[:0]) == threshold(bad[:0], bad) == NO_STRATUM


def test_kept_rows_are_those_selected(spark):
    docs, labels = made()
    docs += [(None, None, "x"), (None, "", None), (7, docs[7][1], "de"), (900, "red fox " * 5000, "long")]
    names = "doc_id long, text string, low_weight string"
    frame = spark.createDataFrame(docs, names).withColumn("noise", F.lit(1))
    made_ = Resampler(frame, spark.createDataFrame(labels, LABELS))
    kept = made_.kept()
    assert kept.columns == frame.columns
    chosen = Counter(r.doc_id for r in made_.weights().filter("selected").collect())
    assert Counter(r.doc_id for r in kept.collect()) == chosen and 900 not in chosen and chosen[7] == 2
    with pytest.raises(ValueError):
        resampler(spark, docs, labels, carry=False).kept()
    assert resampler(spark, [], labels).kept().count() == 0
