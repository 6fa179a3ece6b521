"""A training corpus from raw documents: five stages, each over all that the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from metaloom.llm.decontamination import decontaminate
from metaloom.llm.jaccard_join import near_duplicates
from metaloom.llm.packing import pack_documents
from metaloom.llm.pii import replace_private
from metaloom.llm.quality_resampling import Resampler
from metaloom.llm.queries import PII_KEY, tokenizer_path
from metaloom.operators.joins import unused_name
from metaloom.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects, as labels teach it; junk and toxic ones go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return Resampler(docs.select(*COLUMNS), labels).kept()


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates.

    Rows are told apart by a hash of id and text, so rows that share an id, or have none, are rows like any other: only
    those equal in id and text are one. Of a group the row with the least hash stays.
    """
    key, digest = (unused_name(name, docs) for name in ("row_key", "row_digest"))
    rows = docs.select(*COLUMNS).withColumn(key, F.xxhash64("doc_id", "text"))
    kept = near_duplicates(rows, doc_id=key).filter("doc_id = component_id").select(F.col("doc_id").alias(key))
    one = rows.join(kept.distinct(), key, "left_semi").withColumn(digest, F.md5("text"))
    return one.dropDuplicates(["doc_id", key, digest]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of benchmark items; documents that had nothing else go."""
    others = [name for name in COLUMNS if name not in ("doc_id", "text")]
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=others)
    hit = F.size("spans") > 0
    left = found.filter(~hit | F.col("clean_text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    size = F.when(hit, F.length("clean_text").cast("long")).otherwise(F.col("carried.n_chars"))
    rows = left.select("doc_id", F.col("clean_text").alias("text"), "carried.lang", "carried.source", size.alias("n_chars"))
    return rows.select(*COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by surrogates."""
    clean = replace_private(docs.select(*COLUMNS), PII_KEY)
    changed = F.when(F.col("n_replaced") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicate),
    ("benchmark decontamination", decontamination),
    ("PII", private_data),
    ("best-fit packing", packing),
]

#: Hashed models, components and token ids are beyond SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents, each written to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
