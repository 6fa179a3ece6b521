"""Quality classifier by importance resampling with hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from metaloom.llm.blocks import let_go, return_memory, slices
from metaloom.llm.words import Words, mix, text_words
from metaloom.operators.joins import unused_name
from metaloom.session import stage

#: Labelled documents that the models are fitted and set on at most: those of the least hashes of their ids.
MAX_LABELS = 60_000
#: Hashed features of each kind.
FEATURES = 1 << 18
#: Bytes of a word's head.
HEAD = 5
#: Words of the passages that are looked at for low quality. Toxic ones are single words.
PASSAGE = 16
#: Times the log weight counts against Gumbel noise.
SHARPNESS = 10.0
#: Text bytes whose features are made at a time; words and their features take many times as much.
SLICE_BYTES = 1 << 19
#: Hashed pairs of words.
PAIRS = 1 << 20
#: Cells that keys are counted in at a time, to find the last one selected.
CELLS = 1 << 12
#: Threshold against a stratum that no label is of: below any weight.
NO_STRATUM = -1e6
TARGET, LOW, TOXIC, ALL = range(4)
WORD, HEADS, SHAPE = range(3)
_PAIRS_AT = 3 * FEATURES + 2
#: Words, heads, shapes, first and repeated words, and pairs: how many features, and the stratum they tell from the target.
_KINDS = ((FEATURES, TOXIC), (FEATURES, TOXIC), (FEATURES, LOW), (2, LOW), (PAIRS, TOXIC))

_WEIGHTS = ("low_weight", "toxic_weight", "noise")


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _shape(word: bytes) -> bytes:
    """The kind of a word's first character and its last two bytes."""
    first = word[:1]
    kind = (
        (b"U" if word[-3:-2].isupper() else b"C")
        if first.isupper()
        else b"l"
        if first.islower() or first >= b"\x80"
        else b"d"
        if first.isdigit()
        else first
    )
    return kind + word[-2:]


def _hashed(words: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))
    return (mix(hashes) & np.uint64(FEATURES - 1)).astype(np.int64)


class _Features:
    """Hashed features of several texts: lower-cased words, their heads, and pairs of a word and the one before; shapes
    of raw words, and whether a word repeats the one before."""

    def __init__(self, texts: list[bytes]):
        plain = self.plain = Words(text_words(t) for t in texts)
        raw = self.raw = Words(t.split() for t in texts)
        words, heads = _hashed(plain.vocabulary, WORD), _hashed([w[:HEAD] for w in plain.vocabulary], HEADS)
        shapes = _hashed([_shape(w) for w in raw.vocabulary], SHAPE)
        self.word, self.head, self.shape = words[plain.ids], heads[plain.ids], shapes[raw.ids]
        self.again = np.zeros(len(raw.ids), np.int64)
        self.again[1:] = raw.ids[1:] == raw.ids[:-1]
        self.again[raw.starts[:-1][raw.lengths > 0]] = 0
        hashes = plain.word_hashes(WORD)[plain.ids]
        self.pair = np.empty(len(plain.ids), np.int64)
        self.pair[1:] = (mix(hashes[:-1] * _ODD + hashes[1:]) & np.uint64(PAIRS - 1)).astype(np.int64)
        self.pair[plain.starts[:-1][plain.lengths > 0]] = PAIRS  # before a first word is none

    def count(self, total: np.ndarray, chosen: np.ndarray | None = None, pairs: np.ndarray | None = None) -> None:
        """Add the occurrences of words, heads, shapes, and first and repeated words, which lie one after the other; of
        chosen texts those of pairs as well."""
        columns = [self.word, self.head, self.shape, self.again]
        if chosen is not None:
            plain, raw = (np.repeat(chosen, w.lengths) for w in (self.plain, self.raw))
            columns = [c[m] for c, m in zip(columns, (plain, plain, raw, raw), strict=True)]
        for i, column in enumerate(columns):
            seen, n = np.unique(column, return_counts=True)
            total[seen + i * FEATURES] += n
        if chosen is not None:
            own = self.pair[np.repeat(chosen, self.plain.lengths)]
            seen, n = np.unique(own[own < PAIRS], return_counts=True)
            pairs[seen] += n

    def weights(self, models: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """For each text, the least log weight of a passage against low quality, and of a word against toxicity."""
        words, heads, shapes, again, pairs = models
        low = _least(shapes[self.shape] + again[self.again], self.raw, PASSAGE)
        return low, _least(words[self.word] + heads[self.head] + pairs[self.pair], self.plain, 1)


def _least(values: np.ndarray, words: Words, size: int) -> np.ndarray:
    """The least sum of ``size`` consecutive values of each text; of all, if it has fewer; 0 if none."""
    sums = np.concatenate([[0.0], np.cumsum(values)])
    out = sums[words.starts[1:]] - sums[words.starts[:-1]]
    whole = sums[size:] - sums[:-size] if len(sums) > size else np.empty(0)
    ends = words.ends()[: len(whole)]
    inside = np.where(np.arange(len(whole)) + size <= ends, whole, np.inf)
    long = np.flatnonzero(words.lengths >= size)
    if len(long):
        # each text's windows start in its own places; those that leave it count as infinite
        firsts = words.starts[:-1][long]
        bounds = np.append(np.stack([firsts, np.minimum(words.starts[1:][long], len(inside))], axis=1).ravel(), 0)[:-1]
        padded = np.append(inside, np.inf)
        out[long] = np.minimum.reduceat(padded, bounds)[::2]
    return out


def _chunks(batches: Iterator[pa.RecordBatch], id_at: int, text_at: int) -> Iterator[tuple]:
    """Some rows at a time: the rows, their ids and texts."""
    for batch in batches:
        for part in slices(batch, text_at, SLICE_BYTES):
            ids = part.column(id_at).cast(pa.int64()).to_pylist()
            yield part, ids, [t or b"" for t in part.column(text_at).cast(pa.string()).cast(pa.binary()).to_pylist()]


def labelled_sample(labels: DataFrame, limit: int = MAX_LABELS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and classes of a bounded sample of the labelled documents; of several labels the worst counts."""
    kind = F.when(F.col("quality") == 0, LOW).when(F.col("toxic") == 1, TOXIC).otherwise(TARGET)
    usable = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    kinds = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(kind).alias("kind"))
    rows = sorted(kinds.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect())
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int8)


def _fits(ids: np.ndarray) -> np.ndarray:
    """Which labelled documents fit the models, three in four; the others set the thresholds."""
    return mix(ids.view(np.uint64)) & np.uint64(3) < np.uint64(3)


def _classes(keys: list[int | None], known: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class of each id, or -1."""
    out = np.full(len(keys), -1, np.int8)
    if len(known):
        wanted = np.array([0 if k is None else k for k in keys], np.int64)
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        hit = (known[at] == wanted) & np.array([k is not None for k in keys], bool)
        out[hit] = classes[at[hit]]
    return out


def fit_models(docs: DataFrame, ids: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Log ratios of the target's n-gram model to that of a raw stratum, by feature: words, heads and pairs against toxic
    documents, shapes and repeats against documents of low quality.

    Each model is the counts of the labelled documents of its class. Those of single words are smoothed by the counts of
    all documents, which weigh as much as the smallest class; those of pairs by one for each pair, so that a pair that
    was seen nowhere says little. ``docs`` has ``id, text``.
    """
    fitted = _fits(ids)
    known, classes = ids[fitted], kinds[fitted]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        # a task reads less than two billion words; pairs are counted of the labelled documents alone
        total, pairs = np.zeros((4, _PAIRS_AT), np.int32), np.zeros((3, PAIRS), np.int32)
        for _, keys, texts in _chunks(batches, 0, 1):
            features = _Features(texts)
            features.count(total[ALL])
            own = _classes(keys, known, classes)
            for kind in (TARGET, LOW, TOXIC):
                if (own == kind).any():
                    features.count(total[kind], own == kind, pairs[kind])
        for counts, first in ((total, 0), (pairs, _PAIRS_AT)):
            seen = np.flatnonzero(counts.any(axis=0))
            for at in range(0, len(seen), 1 << 16):
                some = seen[at : at + (1 << 16)]
                columns = [counts[c, some].astype(np.int64) if c < len(counts) else np.zeros(len(some), np.int64) for c in range(4)]
                arrays = [pa.array((some + first).astype(np.int32)), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=["feature", "c0", "c1", "c2", "c3"])
        del total, pairs
        return_memory()

    counted = docs.mapInArrow(count, "feature int, c0 long, c1 long, c2 long, c3 long").groupBy("feature")
    counted = stage(counted.agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(4))), "counts")
    feature, ends = F.col("feature"), np.cumsum([size for size, _ in _KINDS]).tolist()
    kind = F.lit(len(ends) - 1)
    for i in reversed(range(len(ends) - 1)):
        kind = F.when(feature < ends[i], i).otherwise(kind)
    sums = {i: [0.0] * 4 for i in range(len(ends))}
    found = counted.groupBy(kind.alias("kind")).agg(*(F.sum(f"c{i}") for i in range(4))).collect()
    sums |= {r[0]: [float(n) for n in r[1:]] for r in found}
    # counts stay on executors: a driver gets one number a feature, and none of features that are nowhere
    columns, ratio = [F.col(f"c{i}") for i in range(4)], F.lit(0.0)
    for i, (size, against) in enumerate(_KINDS):
        ratio = F.when(kind == i, _ratio(columns, sums[i], size, against)).otherwise(ratio)
    seen = counted.select("feature", ratio.alias("ratio")).toArrow()
    ratios = np.concatenate([np.full(n, _ratio([0.0] * 4, sums[i], n, c)) for i, (n, c) in enumerate(_KINDS)])
    for batch in seen.to_batches():
        ratios[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    models = np.split(np.log(ratios).astype(np.float32), ends[:-1])
    models[-1] = np.append(models[-1], np.float32(0))
    del seen, ratios
    return_memory()
    return tuple(models)


def _ratio(counts: Sequence, sums: Sequence[float], size: int, against: int):
    """The target's share of a feature over that of a raw stratum, by columns or numbers of its counts."""
    if size == PAIRS:
        target, raw = ((counts[c] + 1.0) / (sums[c] + PAIRS) for c in (TARGET, against))
        return target / raw
    corpus = (counts[ALL] + 0.5) / (sums[ALL] + 0.5 * size)
    prior = max(1.0, min(sums[c] for c in (TARGET, LOW, TOXIC)))
    target, raw = ((counts[c] + prior * corpus) / (sums[c] + prior) for c in (TARGET, against))
    return target / raw


def threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The value with the fewest good ones below and bad ones above; the middle of the widest gap of such."""
    values = np.unique(np.concatenate([good, bad]))
    if not len(good) or not len(bad):
        return NO_STRATUM
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    wide = np.concatenate([[1], np.diff(values), [1]])
    good, bad = np.sort(good), np.sort(bad)
    wrong = np.searchsorted(good, cuts) + len(bad) - np.searchsorted(bad, cuts)
    best = np.flatnonzero(wrong == wrong.min())
    return float(cuts[best[np.argmax(wide[best])]])


class Resampler:
    """Importance weights of documents, and which of them a Gumbel top-k draw selects.

    ``labels`` has ``doc_id, quality, toxic``. A target model is fitted to documents of quality 1 that are not
    toxic, raw models to the strata of documents of quality 0 and of toxic ones, from at most ``max_labels``
    labelled rows. A document weighs as its worst passage: ``low_weight`` is the least log ratio of a passage under
    target and low-quality model, ``toxic_weight`` that of a word under target and toxic model. ``log_weight`` is
    the lesser of both after taking off thresholds set on labelled documents that the models have not seen.
    Each row's key is its log weight times ``sharpness`` plus Gumbel noise drawn from a hash of ``seed`` and id; the
    ``keep`` largest keys are selected, or, where ``keep`` is None, as many as have a log weight of 0 or more. With
    ``carry``, documents are written with their weights, so that ``kept`` does not weigh them again.

    Rows with null ids share one draw, as rows of equal ids do. Null and empty texts have weights 0 before
    thresholds. Without labels of some class, that stratum rejects nothing, and the draw decides alone if both are
    missing. Keys equal to the last one selected are selected too. An empty table gives no rows; other columns are
    passed over, or kept by ``kept``, whatever their names.
    """

    def __init__(
        self,
        docs: DataFrame,
        labels: DataFrame,
        keep: int | None = None,
        sharpness: float = SHARPNESS,
        seed: int = 0,
        max_labels: int = MAX_LABELS,
        doc_id: str = "doc_id",
        text: str = "text",
        carry: bool = True,
    ):
        self.docs, self.doc_id, self.text, self.seed, self.sharpness = docs, doc_id, text, seed, sharpness
        columns = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
        ids, kinds = labelled_sample(labels, max_labels)
        self.models: Broadcast = docs.sparkSession.sparkContext.broadcast(fit_models(columns, ids, kinds))
        self.carry = carry
        weighed = docs if carry else columns.select(F.col("id").alias("doc_id"), "text")
        self.names = [unused_name(n, weighed) for n in _WEIGHTS]
        fields = weighed.schema.fields if carry else [T.StructField("doc_id", T.LongType())]
        fields = [*fields, *(T.StructField(n, T.DoubleType()) for n in self.names)]
        places = [weighed.columns.index(n) for n in ((doc_id, text) if carry else ("doc_id", "text"))]
        scored = weighed.mapInArrow(self._scored(*places), T.StructType(fields))
        self.scores = stage(scored, "weights")
        others = ~_fits(ids)
        seen = self._labelled(ids[others], kinds[others])
        self.low = threshold(seen[TARGET][:, 0], seen[LOW][:, 0])
        self.toxic = threshold(seen[TARGET][:, 1], seen[TOXIC][:, 1])
        self.last = self._last(keep)

    def _scored(self, id_at: int, text_at: int):
        models, seed, names, carry = self.models, np.uint64(self.seed), self.names, self.carry

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, keys, texts in _chunks(batches, id_at, text_at):
                low, toxic = _Features(texts).weights(models.value)
                own = part.columns if carry else [part.column(id_at)]
                arrays = [*own, pa.array(low), pa.array(toxic), pa.array(_noise(keys, seed))]
                kept = part.schema.names if carry else ["doc_id"]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

        return run

    def _labelled(self, known: np.ndarray, classes: np.ndarray) -> list[np.ndarray]:
        """Both weights of the known documents, by class; as many rows as the sample has at most for unique ids."""

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = _classes(batch.column(0).to_pylist(), known, classes)
                arrays = [pa.array(own.astype(np.int32)), batch.column(1), batch.column(2)]
                yield pa.RecordBatch.from_arrays(arrays, names=["kind", "low", "toxic"]).filter(pa.array(own >= 0))

        key = F.col(f"`{self.doc_id}`" if self.carry else "doc_id").cast("long").alias("doc_id")
        low, toxic, _ = self.names
        picked = self.scores.select(key, F.col(low).alias("low"), F.col(toxic).alias("toxic")).dropDuplicates(["doc_id"])
        rows = picked.mapInArrow(pick, "kind int, low double, toxic double").toArrow()
        kinds = rows.column("kind").to_numpy()
        both = np.stack([rows.column("low").to_numpy(), rows.column("toxic").to_numpy()], axis=1)
        return [both[kinds == kind] for kind in (TARGET, LOW, TOXIC)]

    def _keys(self) -> tuple[Column, Column]:
        low, toxic, noise = (F.col(n) for n in self.names)
        weight = F.least(low - F.lit(self.low), toxic - F.lit(self.toxic))
        return weight, weight * self.sharpness + noise

    def _last(self, keep: int | None) -> float:
        """The least key selected, exactly: keys are counted in cells, then those of the cell it lies in, and so on."""
        weight, key = self._keys()
        keys = self.scores.select(weight.alias("w"), key.alias("key"))
        wanted = keys.filter("w >= 0").count() if keep is None else keep
        if wanted <= 0:
            return np.inf
        least, most = keys.agg(F.min("key"), F.max("key")).first()
        if least is None or keys.count() <= wanted:
            return -np.inf
        while least < most:
            inside = keys.filter(F.col("key").between(least, most))
            cell = F.floor((F.col("key") - least) / ((most - least) / CELLS)).cast("int").alias("cell")
            found = inside.groupBy(cell).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            for _, n, low, high in sorted((tuple(r) for r in found.collect()), reverse=True):
                if n >= wanted:
                    break
                wanted -= n
            if n == wanted:
                return low
            least, most = low, high
        return least

    def weights(self) -> DataFrame:
        """``doc_id, low_weight, toxic_weight, log_weight, key, selected`` of every row."""
        weight, key = self._keys()
        low, toxic, _ = self.names
        rows = self.scores.select(
            F.col(f"`{self.doc_id}`" if self.carry else "doc_id").cast("long").alias("doc_id"),
            F.col(low).alias("low_weight"),
            F.col(toxic).alias("toxic_weight"),
            weight.alias("log_weight"),
            key.alias("key"),
        )
        return rows.withColumn("selected", F.col("key") >= F.lit(float(self.last)))

    def kept(self) -> DataFrame:
        """The selected rows with all their columns; needs ``carry``."""
        if not self.carry:
            raise ValueError("documents were not carried along")
        return self.scores.filter(self._keys()[1] >= F.lit(float(self.last))).select(*(f"`{c}`" for c in self.docs.columns))


def _noise(keys: list[int | None], seed: np.uint64) -> np.ndarray:
    """Gumbel noise from a hash of each id."""
    ids = np.array([-1 if k is None else k for k in keys], np.int64).view(np.uint64)
    bits = mix(mix(ids + np.uint64(1)) ^ mix(np.array([seed + np.uint64(0x51ED)], np.uint64)))
    uniform = ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
    return -np.log(-np.log(uniform))
