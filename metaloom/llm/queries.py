"""The operators of this package over whole given tables, as registered queries."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metaloom.llm.conversation_repair import repair_conversations
from metaloom.llm.decontamination import decontaminate
from metaloom.llm.hard_negatives import hard_negatives
from metaloom.llm.jaccard_join import near_duplicates
from metaloom.llm.language_id import identify_languages
from metaloom.llm.license_scan import scan_licenses
from metaloom.llm.lm_scoring import score_texts
from metaloom.llm.nearest import nearest
from metaloom.llm.packing import pack_documents
from metaloom.llm.pii import replace_private
from metaloom.llm.quality_resampling import Resampler
from metaloom.llm.substring_dedup import remove_repeats
from metaloom.llm.url_lists import url_host, url_path, url_verdicts

#: Key of surrogates, and first day and number of days of the derived captures.
PII_KEY, FIRST_DAY, DAYS = "corpus", "2023-01-01", 730
Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The tokenizer that documents are packed with; its file lies outside this repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _number(column: Column, seed: str) -> Column:
    """A number from a hash that SQL engines share."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), column)), 1, 8), 16, 10).cast("long")


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a day on which they were fetched, derived from their id."""
    day = F.expr(f"date_add(date'{FIRST_DAY}', cast(days AS int))")
    numbered = pages.select("page_id", "url", (_number(F.col("page_id").cast("string"), "fetch") % DAYS).alias("days"))
    return numbered.select("page_id", "url", day.alias("fetched_on"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of three lists, derived from the pages: one to four for each host, on the host or its parent
    domain, and one for each URL, on its path, where a hash of the URL says so."""
    parts = pages.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")).distinct()
    hosts = parts.filter("host != ''").select("host").distinct().withColumn("h", _number(F.col("host"), "host"))
    turns = hosts.select("host", "h", F.explode(F.sequence(F.lit(0), (F.col("h") % 4).cast("int"))).alias("turn"))
    on_host = turns.select(
        F.when(F.col("h") % 3 == 0, F.regexp_replace("host", r"^[^.]*\.", "")).otherwise(F.col("host")).alias("pattern"),
        F.concat(F.col("host"), F.col("turn").cast("string")).alias("salt"),
    )
    on_path = parts.filter("host != '' AND path != '' AND path != '/'").filter(_number(F.col("url"), "path") % 3 == 0)
    on_path = on_path.select(
        F.regexp_replace(F.concat("host", "path"), "/$", "").alias("pattern"), F.col("url").alias("salt")
    )
    rows = on_host.unionByName(on_path).withColumn("n", _number(F.col("salt"), "entry"))
    return rows.select(
        F.element_at(F.array(F.lit("abuse"), F.lit("adult"), F.lit("spam")), (F.col("n") % 3 + 1).cast("int")).alias(
            "list_name"
        ),
        "pattern",
        F.when(F.col("n") % 20 < 11, "block").when(F.col("n") % 20 < 16, "allow").otherwise("remove").alias("action"),
        F.expr(f"date_add(date'{FIRST_DAY}', cast(n div 20 % {DAYS} AS int))").alias("listed_on"),
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_verdicts(captures(pages), list_entries(pages))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_private(_table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_replaced")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op9_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Resampler(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), carry=False).weights()


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults where a checksum of ``conv_id:turn`` says so. Null roles and texts become one space, and
    so do nulls in the checksum."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.encode(F.concat(known[0], F.lit(":"), known[1]), "utf-8")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault"))
    return rows.filter("fault != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _joined_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ``role:text``, joined by newlines, of each run of rows of one conversation; rows stream past."""
    names = ["conv_id", "repaired_sha256"]
    kind, own, digest = None, None, None
    for batch in batches:
        kind, found = batch.schema.field("conv_id").type, []
        for conv, role, text in zip(*(batch.column(c) for c in ("conv_id", "role", "text")), strict=True):
            if digest is None or conv.as_py() != own:
                if digest is not None:
                    found.append((own, digest.hexdigest()))
                own, digest = conv.as_py(), hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role.as_py()}:{text.as_py()}".encode())
        if found:
            arrays = [pa.array([f[0] for f in found], kind), pa.array([f[1] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([own], kind), pa.array([digest.hexdigest()])], names=names)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    found = repair_conversations(damaged(conversations))
    kind = found.rows.schema["conv_id"].dataType.simpleString()
    ordered = found.rows.repartition("conv_id").sortWithinPartitions("conv_id", "at", "sub")
    hashes = ordered.select("conv_id", "role", "text").mapInArrow(_joined_hash, f"conv_id {kind}, repaired_sha256 string")
    nothing = F.lit(hashlib.sha256().hexdigest())
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = conversations.select("conv_id").distinct().unionByName(found.summaries, allowMissingColumns=True)
    parts = parts.unionByName(hashes, allowMissingColumns=True).groupBy("conv_id")
    return parts.agg(
        *(F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in longs),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), nothing).alias("repaired_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_benchmark_decontamination,
    op2_url_filters,
    op3_ngram_jaccard_join,
    op4_nearest_neighbours,
    op5_pii_surrogates,
    op6_best_fit_packing,
    op7_license_scan,
    op8_substring_dedup,
    op9_quality_resampling,
    op10_lm_scoring,
    op11_conversation_repair,
    op12_hard_negatives,
    op13_language_id,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in OPERATORS}

_OP2 = f"""
WITH numbered AS MATERIALIZED (
    SELECT page_id, url,
        DATE '{FIRST_DAY}' + CAST(('0x' || md5('fetch' || page_id)[1:8])::BIGINT % {DAYS} AS INTEGER) AS fetched_on,
        lower(regexp_replace(
            regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '\\.$', '')) AS host,
        regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
    FROM pages
),
hosts AS (
    SELECT host, ('0x' || md5('host' || host)[1:8])::BIGINT AS h FROM (SELECT DISTINCT host FROM numbered WHERE host != '')
),
salted AS (
    SELECT CASE WHEN h % 3 = 0 THEN regexp_replace(host, '^[^.]*\\.', '') ELSE host END AS pattern,
        host || turn AS salt
    FROM (SELECT host, h, unnest(range(0, h % 4 + 1)) AS turn FROM hosts)
    UNION ALL
    SELECT regexp_replace(host || path, '/$', ''), url
    FROM (SELECT DISTINCT url, host, path FROM numbered)
    WHERE host != '' AND path != '' AND path != '/' AND ('0x' || md5('path' || url)[1:8])::BIGINT % 3 = 0
),
entries AS (
    SELECT ['abuse', 'adult', 'spam'][n % 3 + 1] AS list_name, pattern,
        CASE WHEN n % 20 < 11 THEN 2 WHEN n % 20 < 16 THEN 1 ELSE 0 END AS strength,
        DATE '{FIRST_DAY}' + CAST(n // 20 % {DAYS} AS INTEGER) AS listed_on
    FROM (SELECT pattern, ('0x' || md5('entry' || salt)[1:8])::BIGINT AS n FROM salted)
),
daily AS (SELECT list_name, pattern, listed_on, max(strength) AS strength FROM entries GROUP BY ALL),
spans AS MATERIALIZED (
    SELECT *, lead(listed_on) OVER (PARTITION BY list_name, pattern ORDER BY listed_on) AS until FROM daily
),
keys AS (
    SELECT page_id, fetched_on, unnest(list_concat(
        [array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, len(string_split(host, '.')) + 1)],
        [host || '/' || array_to_string(parts[1:i], '/') FOR i IN range(1, len(parts) + 1)])) AS pattern
    FROM (SELECT *, list_filter(string_split(path, '/'), lambda x: x != '') AS parts FROM numbered WHERE host != '')
),
ranked AS (
    SELECT page_id, keys.pattern, list_name, listed_on, strength, row_number() OVER (PARTITION BY page_id
        ORDER BY length(keys.pattern) DESC, strength DESC, listed_on DESC, list_name DESC, keys.pattern DESC) AS place
    FROM keys JOIN spans ON keys.pattern = spans.pattern AND strength > 0
        AND listed_on <= fetched_on AND (until IS NULL OR fetched_on < until)
)
SELECT n.page_id, n.url, n.fetched_on, n.host,
    CASE r.strength WHEN 2 THEN 'block' WHEN 1 THEN 'allow' ELSE 'none' END AS verdict,
    r.pattern, r.list_name, r.listed_on
FROM numbered n LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r USING (page_id)
"""

_OP11 = """
WITH RECURSIVE checked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
        list_prepend(4294967295, flatten(list_transform(
            string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
            lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
    ), 4294967295) % 20 AS fault
    FROM conversations
),
rows AS MATERIALIZED (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, CASE WHEN fault = 4 THEN 'user' ELSE role END, text) AS n
    FROM (SELECT * FROM checked UNION ALL SELECT * FROM checked WHERE fault = 3) WHERE fault != 0
),
marked AS MATERIALIZED (
    SELECT *, left(role, 1) AS initial, CASE
        WHEN rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
        WHEN right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 'truncated'
        ELSE 'sound' END AS kind,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair
    FROM rows
),
inserts(here, there, audit, cost) AS (VALUES ('0', '0', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0),
    ('0', 'u', 'I', 5), ('s', 'u', 'I', 5), ('u', 'a', 'I', 5), ('a', 'u', 'I', 5), ('0', 'a', 'II', 10), ('s', 'a', 'II', 10)),
keeps(here, there) AS (VALUES ('0', 's'), ('0', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
edits AS (
    SELECT here, there, there AS initial, 'K' AS audit, 0 AS cost, true AS stays FROM keeps
    UNION ALL SELECT here, there, NULL, 'R', 1, true FROM keeps WHERE there != 's'
    UNION ALL SELECT here, here, NULL, 'D', 2, false FROM (VALUES ('0'), ('s'), ('u'), ('a')) AS states(here)
),
moves AS MATERIALIZED (
    SELECT i.here, e.there, e.initial, e.stays, i.audit || e.audit AS audit, i.cost + e.cost AS cost
    FROM inserts i JOIN edits e ON i.there = e.here
),
ways AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS n, '0' AS here, {'cost': 0::BIGINT, 'audit': ''} AS best FROM marked
    UNION ALL
    SELECT w.conv_id, w.n + 1, m.there, min({'cost': (w.best.cost + m.cost
        + CASE WHEN m.stays AND r.kind = 'truncated' THEN 5 ELSE 0 END)::BIGINT, 'audit': w.best.audit || m.audit})
    FROM ways w JOIN marked r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.n + 1
    JOIN moves m ON m.here = w.here AND (m.initial IS NULL OR m.initial = r.initial)
        AND NOT (m.stays AND r.kind IN ('blank', 'duplicate'))
    GROUP BY w.conv_id, w.n + 1, m.there
),
solved AS MATERIALIZED (
    SELECT w.conv_id, min({'cost': (w.best.cost + t.cost)::BIGINT, 'audit': w.best.audit || t.audit}) AS best
    FROM ways w JOIN (VALUES ('0', '', 0), ('a', '', 0), ('u', 'I', 5), ('s', 'II', 10)) AS t(here, audit, cost) USING (here)
    JOIN (SELECT conv_id, max(n) AS n FROM marked GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.n
    GROUP BY w.conv_id
),
letters AS (
    SELECT conv_id, i, substr(audit, i, 1) AS letter,
        len(replace(left(audit, i), 'I', '')) AS n, len(replace(left(audit, i - 1), 'D', '')) AS place
    FROM (SELECT conv_id, best.audit AS audit, unnest(range(1, len(best.audit) + 1)) AS i FROM solved)
),
placed AS (
    SELECT l.*, r.role, r.text,
        max(CASE WHEN letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS systems
    FROM letters l LEFT JOIN marked r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.n = l.n AND letter != 'I'
),
hashed AS (
    SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - systems) % 2 = 0 THEN 'user' ELSE 'assistant' END
        || ':' || coalesce(text, ''), chr(10) ORDER BY i)) AS repaired_sha256
    FROM placed WHERE letter != 'D' GROUP BY conv_id
),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (WHERE kind = 'blank') AS blank, count(*) FILTER (WHERE kind = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE kind = 'truncated') AS truncated,
        count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s.best.cost, 0) AS cost,
    coalesce(s.best.audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_OP12 = """
WITH rows AS MATERIALIZED (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        list_inner_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id != b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0
),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

#: SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op2_url_filters": _OP2, "op11_conversation_repair": _OP11, "op12_hard_negatives": _OP12}
