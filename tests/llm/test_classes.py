"""Classes of deleted tokens: the same as distinct rows, from one number each."""

import numpy as np

from metaloom.llm.lm_scoring import _NONE, distinct_classes


def test_classes_are_those_of_rows():
    rng = np.random.default_rng(1)
    bucket, one, two = rng.integers(0, 40, 5000), rng.integers(-9, 9, 5000), rng.integers(-400, 400, 5000)
    one[::3] = _NONE
    two[::2] = _NONE
    two[1], two[3] = -_NONE - 1, _NONE + 1
    rows, n = np.unique(np.stack([bucket, one, two], axis=1), axis=0, return_counts=True)
    classes, counts = distinct_classes(bucket, one, two)
    assert (np.stack(classes, axis=1) == rows).all() and (counts == n).all()
    empty = np.empty(0, np.int64)
    assert not len(distinct_classes(empty, empty, empty)[1])
