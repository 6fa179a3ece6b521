"""Words and rolling hashes of texts, over numpy arrays.

Texts are UTF-8 bytes. ``bytes.split`` cuts at exactly the characters ``[\\x20\\x09-\\x0D]`` and
``bytes.lower`` changes exactly A-Z, as no byte of a longer UTF-8 sequence is below 0x80.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import xxhash

#: Words of letters, digits and all characters beyond ASCII: every other byte becomes a space.
_TEXT_WORDS = bytes(
    c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 0x20
    for c in range(256)
)

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def text_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return text.translate(_TEXT_WORDS).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts as one sequence of 64-bit hashes.

    ``hashes(seed)`` has one entry a word; text ``i`` owns the entries from ``starts[i]`` to
    ``starts[i + 1]``.
    """

    def __init__(self, lists: Iterable[list[bytes]]):
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        ids, lengths = [], []
        for words in lists:
            ids.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
            lengths.append(len(words))
        index.default_factory = None  # or the index would hold itself until the next collection of cycles
        self.vocabulary = list(index)
        self.ids = np.concatenate(ids) if ids else np.empty(0, np.int32)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)

    def word_hashes(self, seed: int = 0) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(w, seed) for w in self.vocabulary), np.uint64, len(self.vocabulary))

    def hashes(self, seed: int = 0) -> np.ndarray:
        return self.word_hashes(seed)[self.ids]

    def ends(self) -> np.ndarray:
        """For each word, where its text ends."""
        return np.repeat(self.starts[1:], self.lengths)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` entries from each position on; shorter by ``size - 1``.

    Windows of powers of two are joined from halves, then pieces for the bits of ``size``.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, span, out, at = hashes, 1, None, 0
    while True:
        if size & span:
            piece = power[at : at + n]
            out = piece if out is None else mix(out * _GOLDEN + piece + np.uint64(span))
            at += span
        if at == size:
            return out if out is not hashes else out.copy()
        power = mix(power[:-span] * _M1 + power[span:] + np.uint64(span))
        span *= 2
