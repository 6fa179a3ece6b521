"""Language-model scores by deleted interpolation."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metaloom.llm.blocks import (
    Asked,
    Block,
    REQUEST_SCHEMA,
    answers,
    buckets_for,
    each_block,
    of_part,
    requests,
    text_blocks,
    with_answers,
)
from metaloom.llm.words import Words, mix
from metaloom.session import stage

#: Not a word. Ends every text, and stands before its first word.
END = b"\n"
#: Contexts seen 2^k to 2^(k+1) - 1 times share weights; unseen ones have bucket 0.
CONTEXT_BUCKETS = 40
#: Steps of a ratio of probabilities by which deleted tokens are gathered, for a doubling.
STEPS = 4
EM_ROUNDS = 100
#: Text bytes of a block; a task holds some twenty numbers for each of its tokens.
BLOCK_BYTES = 4 << 20
#: Text bytes for each bucket: its task holds a few copies of all their distinct n-grams.
BUCKET_BYTES = 8 << 20

SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
_GATHERED = pa.schema([("bucket", pa.int32()), ("unigram", pa.int32()), ("bigram", pa.int32()), ("n", pa.int64())])
_NONE = -(1 << 20)
#: Two big-endian numbers that each bucket adds to its answers: where their hex digits start.
_SUMS = {"total": 1, "kinds": 17}


def held_out(doc_id: int | None) -> bool:
    """Whether learning leaves the document out: one in ten, by CRC-32 of its id as text (null: empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


class _Tokens:
    """A block's tokens and the keys of their unigrams (even) and bigrams (odd)."""

    def __init__(self, block: Block):
        self.words = Words(t.lower().split() + [END] for t in block.texts())
        ids = self.words.ids
        hashes = self.words.word_hashes()
        end = np.int32(self.words.vocabulary.index(END))
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[self.words.starts[:-1]] = end
        one = hashes & ~np.uint64(1)
        self.bigrams, self.bigram = np.unique(
            mix(hashes[before] * np.uint64(0x9E3779B97F4A7C15) + hashes[ids]) | np.uint64(1), return_inverse=True
        )
        self.keys = np.concatenate([one, self.bigrams])
        self.order = np.argsort(self.keys)
        self.ids, self.before, self.size = ids, before, len(one)

    def counts(self) -> np.ndarray:
        """Occurrences of each key here, in the order of keys asked."""
        ones = np.bincount(self.ids, minlength=self.size)
        return np.concatenate([ones, np.bincount(self.bigram, minlength=len(self.bigrams))])[self.order]

    def known(self, answer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Training counts of each token's context, of the token, and of both together."""
        counts = np.empty(len(self.keys), np.int64)
        counts[self.order] = np.frombuffer(answer, np.int64)
        return counts[: self.size][self.before], counts[: self.size][self.ids], counts[self.size :][self.bigram]


def context_bucket(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, np.minimum(np.log2(np.maximum(counts, 1)).astype(int) + 1, CONTEXT_BUCKETS - 1), 0)


def distinct_classes(bucket: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct triples, in order, and how often each occurs; triples are sorted as one number of 64 bits each.

    Ratios of estimates are from ``_NONE`` to below -``_NONE``.
    """
    wide = np.int64(2 * -_NONE)
    packed, n = np.unique((bucket * wide + (one - _NONE)) * wide + (two - _NONE), return_counts=True)
    rest, two = np.divmod(packed, wide)
    bucket, one = np.divmod(rest, wide)
    return [bucket, one + _NONE, two + _NONE], n


def _estimates(tokens: tuple[np.ndarray, ...], total: int, kinds: int | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximum-likelihood probabilities of each token: uniform over all kinds and one unknown, unigram, bigram."""
    context, token, both = tokens
    uniform = np.full(len(token), 1 / (kinds + 1))
    return uniform, token / max(total, 1), np.divide(both, context, out=np.zeros(len(both)), where=context > 0)


def learn_weights(gathered: list[tuple[int, int, int, int]], rounds: int = EM_ROUNDS) -> np.ndarray:
    """Mixture weights (uniform, unigram, bigram) of each context bucket by expectation-maximisation.

    ``gathered`` has (bucket, unigram, bigram, n): ``n`` deleted tokens whose unigram and bigram estimates are
    2^(x / STEPS) times the uniform one. A bucket without tokens takes the weights of all tokens together.
    """

    def fit(rows: np.ndarray) -> np.ndarray:
        ratios = np.ones((len(rows), 3))
        for column in (1, 2):
            ratios[:, column] = np.where(rows[:, column] == _NONE, 0, 2.0 ** (rows[:, column] / STEPS))
        weights = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = ratios * weights
            share /= share.sum(axis=1, keepdims=True)
            weights = (share * rows[:, 3:]).sum(axis=0) / rows[:, 3].sum()
        weights = np.maximum(weights, 1e-9)  # unknown tokens stay possible
        return weights / weights.sum()

    rows = np.array(gathered, np.float64).reshape(-1, 4)
    weights = np.tile(fit(rows) if len(rows) else np.full(3, 1 / 3), (CONTEXT_BUCKETS, 1))
    for bucket in range(CONTEXT_BUCKETS):
        own = rows[rows[:, 0] == bucket]
        if len(own):
            weights[bucket] = fit(own)
    return weights


def score_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", left_out: Callable[[int | None], bool] = held_out
) -> DataFrame:
    """Log10 probabilities of whole texts under an interpolated bigram model and under a smoothed unigram base.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end. All rows that are not
    ``left_out`` by id are counted. ``score`` mixes the uniform, unigram and bigram maximum-likelihood estimates of
    each token with weights that depend on how often its context was counted and that expectation-maximisation
    learned on the counted tokens, each with itself taken out of the counts; rows left out are scored only. Before the first word the context is the end. ``base_score`` sums
    ``log10((c + 0.1) / (N + 0.1 * (V + 1)))``. Returns ``doc_id, held_out, n_tokens, n_known`` (tokens counted in
    training), ``train_tokens`` (N) and both scores.

    The tokens gathered for learning are pooled in classes of context bucket and ratios of estimates, so what
    reaches the driver is bounded; counts, N, V and scores are exact but for collisions of 64-bit hashes.

    Null and empty texts have the end as only token. Rows with a null id are left out; rows that repeat an id or a
    text count each time. Without training rows all tokens are unknown and the weights are
    equal. An empty table gives no rows; other columns are ignored; a very long text is a block of its own.
    """
    blocks = text_blocks(docs, lambda key: int(left_out(key)), BLOCK_BYTES, doc_id=doc_id, text=text)
    buckets = buckets_for(blocks, BUCKET_BYTES)

    def ask(block: Block) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens(block)
        counts = tokens.counts() if block.part == 0 else np.zeros(len(tokens.keys), np.int64)
        yield requests(block.block, tokens.keys[tokens.order], counts.astype(np.uint32), buckets)

    def count(table: pa.Table) -> pa.Table:
        asked = Asked(table, np.uint32)
        totals = asked.totals()
        single, firsts = np.unique(asked.keys, return_index=True)
        seen = totals[firsts][(single & np.uint64(1) == 0)]
        sums = np.array([seen.sum(), (seen > 0).sum()], ">i8")
        own = pa.Table.from_pydict(
            {"block": [-1], "bucket": [asked.bucket], "answer": [sums.tobytes()]}, asked.answer(totals[:0]).schema
        )
        return pa.concat_tables([asked.answer(totals), own])

    counts = stage(answers(each_block(blocks, ask, REQUEST_SCHEMA), count), "counts")
    sums = counts.filter("block = -1").select(
        *(F.conv(F.substring(F.hex("answer"), at, 16), 16, 10).cast("long").alias(name) for name, at in _SUMS.items())
    )
    total, kinds = (x or 0 for x in sums.agg(*(F.sum(name) for name in _SUMS)).first())
    replies = counts.filter("block >= 0")

    def gather(block: Block, answer: bytes) -> Iterator[pa.RecordBatch]:
        known = _Tokens(block).known(answer)
        # each token is taken out of the counts that estimate it
        uniform, unigram, bigram = _estimates(tuple(x - 1 for x in known), total - 1, kinds - (known[1] == 1))
        with np.errstate(divide="ignore"):
            one, two = (np.round(STEPS * np.log2(x / uniform)) for x in (unigram, bigram))
        ratios = (np.where(np.isinf(x), _NONE, x).astype(np.int64) for x in (one, two))
        classes, n = distinct_classes(context_bucket(known[0] - 1), *ratios)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x.astype(np.int32)) for x in classes), pa.array(n.astype(np.int64))], schema=_GATHERED
        )

    deleted = with_answers(of_part(blocks, 0), of_part(replies, 0), gather, "bucket int, unigram int, bigram int, n long")
    pooled = deleted.groupBy("bucket", "unigram", "bigram").agg(F.sum("n").alias("n"))
    weights = learn_weights([tuple(r) for r in pooled.collect()])

    def score(block: Block, answer: bytes) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens(block)
        known = tokens.known(answer)
        mixed = sum(w * p for w, p in zip(weights[context_bucket(known[0])].T, _estimates(known, total, kinds), strict=True))
        base = (known[1] + 0.1) / (total + 0.1 * (kinds + 1))
        cuts = tokens.words.starts[:-1]
        n = len(cuts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(block.ids, pa.int64()),
                pa.array([block.part == 1] * n),
                pa.array(tokens.words.lengths),
                pa.array(np.add.reduceat((known[1] > 0).astype(np.int64), cuts)),
                pa.array([total] * n, pa.int64()),
                pa.array(np.add.reduceat(np.log10(base), cuts)),
                pa.array(np.add.reduceat(np.log10(mixed), cuts)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return with_answers(blocks, replies, score, SCHEMA)
