"""N-gram Jaccard join by vertical partitioning of the global n-gram order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from metaloom.llm.blocks import (
    Asked,
    Block,
    REQUEST_SCHEMA,
    answers,
    buckets_for,
    each_block,
    requests,
    text_blocks,
    trimmed,
    with_answers,
)
from metaloom.llm.components import rooted, stars
from metaloom.llm.words import Words, window_hashes
from metaloom.operators.joins import skew_safe_join
from metaloom.session import stage

#: Parts of the global n-gram order whose overlaps are counted separately.
FRAGMENTS = 8
#: Rounds of comparing with one pivot a bucket before all remaining pairs of a bucket are compared.
ROUNDS = 2

SCHEMA = "doc_id long, signature binary, n_shingles long, tokens array<long>, prefix array<long>"
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("signature", pa.binary()),
        ("n_shingles", pa.int64()),
        ("tokens", pa.list_(pa.int64())),
        ("prefix", pa.list_(pa.int64())),
    ]
)


def shingle_sets(texts: Iterator[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of lower-cased words."""
    words = Words(t.lower().split() for t in texts)
    hashes = words.hashes()
    whole = window_hashes(hashes, size)
    sets = []
    for a, b in zip(words.starts[:-1], words.starts[1:], strict=True):
        if b - a >= size:
            sets.append(np.unique(whole[a : b - size + 1]))
        else:  # the whole sequence; hashed as a window of its own length
            sets.append(window_hashes(hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return sets


def _signature(one: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(one.tobytes()) if len(one) else None


class _Local:
    """A block's sets: one of each signature, and the distinct keys of their n-grams."""

    def __init__(self, block: Block, size: int, buckets: int):
        self.sets = shingle_sets(block.texts(), size)
        self.signatures = [_signature(s) for s in self.sets]
        self.firsts = {s: i for i, s in reversed(list(enumerate(self.signatures))) if s is not None}
        own = [trimmed(self.sets[i], buckets) for i in self.firsts.values()]
        self.lengths = [len(x) for x in own]
        self.keys, self.inverse, counts = np.unique(
            np.concatenate([*own, np.empty(0, np.uint64)]), return_inverse=True, return_counts=True
        )
        self.counts = np.minimum(counts, 255).astype(np.uint8)


def _scaled(totals: np.ndarray) -> np.ndarray:
    """Counts in a byte: exact below 127, then eight steps for each doubling; order is kept."""
    large = np.minimum(127 + 8 * np.log2(np.maximum(totals, 127) / 127), 255)
    return np.where(totals < 127, totals, large).astype(np.uint8)


def _sharing(docs: DataFrame, size: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """Every document with its signature and size; one of each signature in a block that may have links also
    has its shared n-grams and its prefix."""
    blocks = text_blocks(docs, doc_id=doc_id, text=text)
    buckets = buckets_for(blocks)

    def ask(block: Block) -> Iterator[pa.RecordBatch]:
        local = _Local(block, size, buckets)
        yield requests(block.block, local.keys, local.counts, buckets, trim=True)

    def count(table: pa.Table) -> pa.Table:
        asked = Asked(table, np.uint8, trim=True)
        return asked.answer(_scaled(asked.totals()))

    def choose(block: Block, answer: bytes) -> Iterator[pa.RecordBatch]:
        local = _Local(block, size, buckets)
        counts = np.frombuffer(answer, np.uint8)[local.inverse]
        tokens: list[np.ndarray | None] = [None] * len(local.sets)
        prefix: list[np.ndarray | None] = [None] * len(local.sets)
        at = 0
        for place, length in zip(local.firsts.values(), local.lengths, strict=True):
            one, seen = local.sets[place], counts[at : at + length]
            at += length
            shared = seen > 1
            least = -(-percent * length // 100)  # an overlap that any link needs
            if shared.sum() < least:
                continue
            mine = one[shared]
            first = length - least + 1 - (length - len(mine))
            rank = np.lexsort((mine, seen[shared]))[:first]
            tokens[place], prefix[place] = mine.view(np.int64), mine[rank].view(np.int64)
        for at in range(0, len(tokens), 256):
            part = slice(at, at + 256)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids[part], pa.int64()),
                    pa.array(local.signatures[part], pa.binary()),
                    pa.array([len(s) for s in local.sets[part]], pa.int64()),
                    pa.array(tokens[part], pa.list_(pa.int64())),
                    pa.array(prefix[part], pa.list_(pa.int64())),
                ],
                schema=_OUT,
            )

    shared = answers(each_block(blocks, ask, REQUEST_SCHEMA), count)
    return stage(with_answers(blocks, shared, choose, SCHEMA), "shingle-sets")


def _may_link(x: str, y: str, percent: int) -> Column:
    """Whether two sets can be similar if the bucket's n-gram is the first they share, at these ranks.

    Similar sets pass in the bucket of the first n-gram they share, so none is lost.
    """
    both = F.least(F.col(f"{x}.n") - F.col(f"{x}.rank"), F.col(f"{y}.n") - F.col(f"{y}.rank"))
    return both * (100 + percent) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * percent


def _linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` similar enough: overlaps counted by fragment, then summed."""
    # both sides meet the same exchange of segments, so it is written once
    left = segments.select(
        F.col("signature").alias("a"), "fragment", F.col("segment").alias("seg_a"), F.col("n").alias("n_a")
    )
    right = segments.select(
        F.col("signature").alias("b"), "fragment", F.col("segment").alias("seg_b"), F.col("n").alias("n_b")
    )
    sizes_fit = (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    asked = pairs.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("fragment"))
    sided = asked.join(left, ["a", "fragment"]).join(right, ["b", "fragment"]).filter(sizes_fit)
    partial = F.size(F.array_intersect("seg_a", "seg_b")).cast("long")
    overlap = sided.groupBy("a", "b", "n_a", "n_b").agg(F.sum(partial).alias("both"))
    enough = F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent
    return overlap.filter(enough).select("a", "b")


def similarity_links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``(a, b)`` between signatures that connect exactly what all similar pairs connect.

    Candidates share an n-gram of their prefixes. All pairs in a bucket of candidates are not compared: first
    each set meets one pivot of its buckets, then every bucket that still holds several components compares one
    pivot with the sets outside its component, and what is left at the end is compared whole. Pairs that are
    skipped lie within one component already.
    """
    classes = stage(
        sets.filter("tokens IS NOT NULL")
        .groupBy("signature")
        .agg(F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens"), F.first("prefix").alias("prefix")),
        "classes",
    )
    width = (1 << 64) // FRAGMENTS
    bounds = [width * i - (1 << 63) for i in range(FRAGMENTS + 1)]

    def fragment(i: int):
        low, high = F.lit(bounds[i]), F.lit(bounds[i + 1] - 1)
        return F.struct(
            F.lit(i).alias("fragment"),
            F.filter("tokens", lambda t: (t >= low) & (t <= high)).alias("segment"),
        )

    pieces = F.explode(F.array(*(fragment(i) for i in range(FRAGMENTS)))).alias("piece")
    segments = classes.select("signature", "n", pieces).select("signature", "n", "piece.*").filter("size(segment) > 0")
    entries = classes.select(
        "signature", "n", (F.col("n") - F.size("tokens")).alias("alone"), F.posexplode("prefix").alias("place", "token")
    )
    rank = (F.col("alone") + F.col("place")).alias("rank")
    entries = entries.select("token", F.struct(rank, "signature", "n").alias("one"))
    crowd = entries.groupBy("token").agg(F.count("*").alias("m"), F.min("one").alias("pivot")).filter("m > 1")
    entries = stage(skew_safe_join(entries, crowd, ["token"], "inner"), "buckets")
    near = entries.filter("one.signature != pivot.signature").filter(_may_link("one", "pivot", percent))
    nearest = near.groupBy("one.signature").agg(F.min("pivot").alias("pivot"))
    nearest = nearest.select(F.col("pivot.signature").alias("a"), F.col("signature").alias("b"))
    links = stage(_linked(nearest, segments, percent), "similar")
    entries = entries.select("token", "one")
    for turn in range(ROUNDS):
        # the stars of what is known connect what its links do, and the next turn has less to find
        links = stars(links)
        roots = rooted(links).withColumnRenamed("node", "signature")
        placed = entries.withColumn("signature", F.col("one.signature")).join(roots, "signature", "left")
        placed = placed.select("token", "one", F.coalesce("root", "signature").alias("root"))
        spread = placed.groupBy("token", "root").agg(F.count("*").alias("n"), F.min("one").alias("head"))
        mixed = spread.groupBy("token").agg(
            F.sum("n").alias("m"),
            F.sum(F.col("n").cast("double") * F.col("n")).alias("inner"),
            F.max(F.struct("n", "head", "root")).alias("top"),
        )
        mixed = stage(mixed.filter("top.n < m"), "mixed")
        left = mixed.agg(F.sum("m").alias("m"), F.sum(F.expr("double(m) * m - inner")).alias("pairs")).first()
        if not left["m"]:
            return links
        entries = stage(skew_safe_join(placed, mixed.select("token", "top"), ["token"], "inner"), "buckets")
        if turn == ROUNDS - 1 or left["pairs"] <= 4 * left["m"]:
            break
        outside = entries.filter("root != top.root").filter(_may_link("one", "top.head", percent))
        pairs = outside.select(
            F.least("one.signature", "top.head.signature").alias("a"),
            F.greatest("one.signature", "top.head.signature").alias("b"),
        ).distinct()
        links = stage(links.unionByName(_linked(pairs, segments, percent)), "similar")
        entries = entries.select("token", "one")
    # one side of each pair is outside its bucket's largest component
    loose = entries.filter("root != top.root")
    first = loose.select("token", F.col("one").alias("x"), F.col("root").alias("root_x"), F.col("top.root").alias("main"))
    second = entries.select("token", F.col("one").alias("y"), F.col("root").alias("root_y"))
    apart = F.expr("root_x != root_y AND (root_y = main OR x.signature < y.signature)") & _may_link("x", "y", percent)
    rest = first.join(second, (first["token"] == second["token"]) & apart)
    rest = rest.select(F.col("x.signature").alias("a"), F.col("y.signature").alias("b")).distinct()
    return links.unionByName(_linked(rest, segments, percent))


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a set holds the distinct shingles of
    ``size`` words, or the whole sequence if there are fewer words. Returns one row per row of ``docs``:
    ``doc_id, signature, n_shingles, component_id``, the last being the smallest id reachable by links.

    Method. Documents of equal sets are one class. The global n-gram order (rarest first, then by hash) gives
    each class a prefix, and linked classes share an n-gram of their prefixes; n-grams that one class alone
    holds come first and cost no comparison, so a class with too many of them has no links at all. The order of
    hashes is cut into fragments; overlaps of candidate pairs are counted in each fragment and summed per pair.

    Null and empty texts have no words, ``n_shingles`` 0, a null signature and no links: their component is
    their own id. Null ids are never the smallest id; a component of null ids alone has a null id. Rows that
    repeat an id or a text are rows like any other. An empty table gives no rows; other columns are ignored.
    """
    sets = _sharing(docs, size, percent, doc_id, text)
    roots = rooted(stars(similarity_links(sets, percent))).withColumnRenamed("node", "signature")
    rows = sets.select("doc_id", "signature", "n_shingles")
    # the smallest id of each class first, so that the join with roots has one row a class
    classes = rows.filter("n_shingles > 0").groupBy("signature").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots, "signature", "left").withColumn("root", F.coalesce("root", "signature"))
    heads = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    found = skew_safe_join(classes.select("signature", "root"), heads, ["root"], "inner")
    found = found.select("signature", "component_id")
    texts = skew_safe_join(rows.filter("n_shingles > 0"), found, ["signature"], "inner")
    empty = rows.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return texts.unionByName(empty).select("doc_id", "signature", "n_shingles", "component_id")
