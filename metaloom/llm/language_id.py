"""Language identification by a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from metaloom.llm.blocks import slices

#: Bytes of a window; the widest filter's last bytes are the next window's first, so every filter sees every place once.
WINDOW_BYTES = 256
#: Numbers for a byte, bytes that filters span, and filters of each width.
EMBEDDING, WIDTHS, FILTERS = 8, (2, 3, 4), 16
#: What the network is fitted on at most: languages (the most frequent), documents of each, windows of a document.
MOST_LANGUAGES, DOCUMENTS_EACH, WINDOWS_EACH = 64, 300, 4
EPOCHS, BATCH, RATE = 5, 64, 0.01
UNKNOWN = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"

_STRIDE = WINDOW_BYTES - max(WIDTHS) + 1
_PLACES = _STRIDE
#: Windows that are scored at once, and bytes of a text that are cut at once.
_CHUNK, _PIECE = 512, _STRIDE << 12
#: Bytes that letters consist of.
_LETTER = np.array([c >= 0x80 or chr(c).isalpha() for c in range(256)])
#: Zero is the end of a short window, so it is no byte of a text; A-Z count as lower case.
_FOLDED = bytes([0x20, *range(1, 256)]).lower()


def held_out(doc_id: Column) -> Column:
    """Whether learning leaves the document out: one in four, by CRC-32 of its id as text (null: empty text)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % 4 == 2


def windows_of(text: bytes) -> np.ndarray:
    """A text as rows of ``WINDOW_BYTES`` bytes, each beginning with the last bytes of the one before; zeros at the end."""
    text = text.translate(_FOLDED)
    n = max(1, -(-(len(text) - WINDOW_BYTES + _STRIDE) // _STRIDE))
    data = np.zeros((n - 1) * _STRIDE + WINDOW_BYTES, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, WINDOW_BYTES)[::_STRIDE]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


@dataclass
class ByteNetwork:
    """Byte embeddings, filters of several widths, the greatest answer of each over a window, and a softmax layer."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    output: np.ndarray
    offset: np.ndarray

    @staticmethod
    def fresh(languages: list[str], rng: np.random.Generator) -> ByteNetwork:
        n = FILTERS * len(WIDTHS)
        return ByteNetwork(
            languages,
            rng.normal(0, 1, (256, EMBEDDING)),
            [rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS],
            np.zeros(n),
            rng.normal(0, n**-0.5, (n, len(languages))),
            np.zeros(len(languages)),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.output, self.offset]

    def gradients(self, windows: np.ndarray, targets: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy. Only the place where a filter answers most moves it."""
        rows, columns = np.arange(len(windows))[:, None], np.arange(FILTERS)
        best, places = [], []
        for filters in self.filters:
            answer = sum((self.embedding @ f)[windows[:, k : k + _PLACES]] for k, f in enumerate(filters))
            places.append(answer.argmax(axis=1))
            best.append(answer[rows, places[-1], columns])
        raw = np.concatenate(best, axis=1) + self.bias
        features = np.maximum(raw, 0)
        error = _softmax(features @ self.output + self.offset)
        error[np.arange(len(targets)), targets] -= 1
        error /= len(targets)
        back = (error @ self.output.T) * (raw > 0)
        embedding, moved = np.zeros_like(self.embedding), []
        for i, (filters, place) in enumerate(zip(self.filters, places, strict=True)):
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            moved.append(np.empty_like(filters))
            for k, f in enumerate(filters):
                at = windows[rows, place + k].astype(np.int64) * FILTERS + columns
                table = np.bincount(at.ravel(), own.ravel(), 256 * FILTERS).reshape(256, FILTERS)
                moved[-1][k] = self.embedding.T @ table
                embedding += table @ f.T
        return [embedding, *moved, back.sum(axis=0), features.T @ error, error.sum(axis=0)]

    @staticmethod
    def fit(languages: list[str], windows: np.ndarray, targets: np.ndarray, seed: int = 0) -> ByteNetwork:
        """Trained by Adam. Of every second window only the beginning is shown, as texts may be short."""
        rng = np.random.default_rng(seed)
        network = ByteNetwork.fresh(languages, rng)
        first = [np.zeros_like(p) for p in network.parameters()]
        second = [np.zeros_like(p) for p in network.parameters()]
        step = 0
        for epoch in range(EPOCHS):
            shown = windows.copy()
            lengths = np.where(rng.random(len(windows)) < 0.5, rng.integers(8, WINDOW_BYTES, len(windows)), WINDOW_BYTES)
            shown[np.arange(WINDOW_BYTES) >= lengths[:, None]] = 0
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                own = order[at : at + BATCH]
                step += 1
                rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                found = network.gradients(shown[own], targets[own])
                for p, g, m, v in zip(network.parameters(), found, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * m / (np.sqrt(v) + 1e-8)
        return network


class Scorer:
    """A network's answers as tables by pairs of bytes, so that a place of a window costs two lookups."""

    def __init__(self, network: ByteNetwork):
        first, second = np.divmod(np.arange(65536), 256)
        tables = [[(network.embedding @ f).astype(np.float32) for f in filters] for filters in network.filters]
        self.here = np.concatenate([t[0][first] + t[1][second] for t in tables], axis=1)
        parts = [
            sum((t[2 + k][b] for k, b in enumerate((first, second)[: len(t) - 2])), np.zeros((65536, FILTERS), np.float32))
            for t in tables[1:]
        ]
        self.ahead = np.concatenate(parts, axis=1)
        self.bias = network.bias.astype(np.float32)
        self.output, self.offset = network.output.astype(np.float32), network.offset.astype(np.float32)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = [self._chunk(windows[at : at + _CHUNK]) for at in range(0, len(windows), _CHUNK)]
        return np.concatenate(out)

    def _chunk(self, windows: np.ndarray) -> np.ndarray:
        data = np.ascontiguousarray(windows.T).astype(np.int64)
        pairs = data[:-1] * 256 + data[1:]
        most = np.full((len(windows), self.here.shape[1]), -np.inf, np.float32)
        here, ahead = np.empty_like(most), np.empty((len(windows), self.ahead.shape[1]), np.float32)
        for place in range(_PLACES):
            np.take(self.here, pairs[place], axis=0, out=here, mode="clip")
            np.take(self.ahead, pairs[place + 2], axis=0, out=ahead, mode="clip")
            here[:, FILTERS:] += ahead
            np.maximum(most, here, out=most)
        logits = np.maximum(most + self.bias, 0) @ self.output + self.offset
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Mean log probabilities of each whole text: its windows weighted by their letters' bytes."""
        sums, weights = np.zeros((len(texts), len(self.offset))), np.zeros(len(texts))
        held: list[np.ndarray] = []
        own: list[int] = []

        def close() -> None:
            windows = np.concatenate(held)
            n = np.repeat(own, [len(h) for h in held])
            letters = _LETTER[windows].sum(axis=1) + 1e-9
            np.add.at(sums, n, self.log_probabilities(windows) * letters[:, None])
            np.add.at(weights, n, letters)
            held.clear()
            own.clear()

        size = 0
        for i, text in enumerate(texts):
            for at in range(0, max(1, len(text) - (WINDOW_BYTES - _STRIDE)), _PIECE):
                held.append(windows_of(text[at : at + _PIECE + WINDOW_BYTES - _STRIDE]))
                own.append(i)
                size += len(held[-1])
                if size >= 4 * _CHUNK:
                    close()
                    size = 0
        if held:
            close()
        return sums / weights[:, None] if len(texts) else sums


def _labelled(docs: DataFrame, doc_id: str, text: str, lang: str, learned: Column) -> DataFrame:
    return docs.filter(learned).select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(doc_id).cast("string"), F.col(text).cast("string")).alias("place"),
    ).filter("lang IS NOT NULL AND text IS NOT NULL")


def fit_language_model(
    docs: DataFrame,
    learned: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    seed: int = 0,
    languages: int = MOST_LANGUAGES,
    documents_each: int = DOCUMENTS_EACH,
) -> ByteNetwork | None:
    """A network for the most frequent ``languages`` among the rows for which ``learned`` holds; None without any.

    It is fitted on a sample: of each language the ``documents_each`` documents whose hash is least, and up to
    ``WINDOWS_EACH`` windows of each, spread over the text. So what reaches the driver is bounded by the parameters. Rows
    without a language or a text are not learned from.
    """
    rows = _labelled(docs, doc_id, text, lang, learned)
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return None
    known = sorted(r["lang"] for r in counts)
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 4.0 * documents_each / r["count"])) for r in counts], "lang string, share double"
    )
    near = rows.join(F.broadcast(shares), "lang").filter(F.pmod("place", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    order = Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(1 << 20)), "place")
    chosen = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= documents_each).select("lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, langs = [], []
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                windows = windows_of(value.encode())
                spread = np.unique(np.linspace(0, len(windows) - 1, WINDOWS_EACH).astype(int))
                kept = [w for w in windows[spread] if _LETTER[w].any()]
                found += [w.tobytes() for w in kept]
                langs += [name] * len(kept)
            arrays = [pa.array(langs, pa.string()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "window"])

    sample = sorted((r["lang"], bytes(r["window"])) for r in chosen.mapInArrow(cut, "lang string, window binary").collect())
    if not sample:
        return None
    windows = np.stack([np.frombuffer(w, np.uint8) for _, w in sample])
    return ByteNetwork.fit(known, windows, np.array([known.index(name) for name, _ in sample]), seed)


def identify_languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 0
) -> DataFrame:
    """The language of every whole text: ``doc_id, held_out, lang_pred, score``.

    The network learns from the texts and languages of documents that are not ``held_out`` (``fit_language_model``); a
    prediction sees the text alone. A text's bytes are cut into windows of ``WINDOW_BYTES``, the windows of many texts
    are scored together, and the mean of their log probabilities, weighted by how many bytes of letters they hold, is
    normalised to the score. Map only; a long text is scored in pieces of bounded size.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if there is nothing to learn
    from. Ties go to the first language in the order of names. A null id is not held out. Rows repeated come back as
    often. An empty table gives no rows; other columns are ignored.
    """
    network = fit_language_model(docs, ~held_out(F.col(doc_id)), doc_id, text, lang, seed)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        held_out(F.col(doc_id)).alias("held_out"),
    )
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if network is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        names = np.array(shared.value.languages, object)
        for whole in batches:
            for batch in slices(whole, 1):
                speaks = np.array(batch.column("letters").to_pylist(), bool)
                texts = batch.column("text").to_pylist()
                own = np.flatnonzero(speaks)
                found = scorer.texts([texts[i].encode() for i in own])
                languages, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                if len(own):
                    languages[own], scores[own] = names[found.argmax(axis=1)], _softmax(found).max(axis=1)
                arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(languages, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", "text", "held_out", letters.alias("letters")).mapInArrow(predict, SCHEMA)
