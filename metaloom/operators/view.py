"""The enriched view: metadata, its tags as columns, and a link."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metaloom import fixed_values as fv, schemas
from metaloom.functions.attributes import link
from metaloom.functions.text import fill_sql, quoted, sql_literal
from metaloom.operators.joins import skew_safe_join
from metaloom.operators.tags import pivot_tags


def enriched_view(metadata: DataFrame, tags: DataFrame, colocated: bool = False) -> DataFrame:
    """Every metadata row with its discovery tags and, once synced, its link.

    Tags hang on names, not ids: a renamed table is untagged until tagged anew, and records
    that share names share tags. Tags are pivoted before the join, so it never fans out.
    ``colocated`` inputs lie in buckets of the names (see ``plans.colocated``) and are joined where
    they are.
    """
    names = dict(zip(schemas.TAG_KEYS, schemas.SOURCE_NAMES))
    pivoted = pivot_tags(tags, colocated).withColumnsRenamed(names)
    if colocated:
        joined = metadata.join(pivoted, list(schemas.SOURCE_NAMES), "left")
    else:
        joined = skew_safe_join(metadata, pivoted, schemas.SOURCE_NAMES, "left")
    return joined.withColumn(fv.LINK, link()).select(*schemas.VIEW.names)


def view_text(metadata: str, tags: str) -> str:
    """The enriched view as a query over two stored tables, given by their quoted names.

    The same rows as ``enriched_view``, and the same plan: tags are combined map-side, and a
    hash of the names in the join condition keeps a hot name splittable.
    """
    names, keys = ", ".join(f"m.{quoted(c)}" for c in schemas.SOURCE_NAMES), ", ".join(map(quoted, schemas.TAG_KEYS))
    kept = ", ".join(sql_literal(n) for n in schemas.TAG_NAMES)
    pivot = ", ".join(
        f"max(CASE WHEN tag_name = {sql_literal(n)} THEN tag_value END) AS {quoted(n)}" for n in schemas.TAG_NAMES
    )
    same = " AND ".join(
        f"m.{quoted(n)} = t.{quoted(k)}" for n, k in zip(schemas.SOURCE_NAMES, schemas.TAG_KEYS, strict=True)
    )
    account = [f"lower(get(split(m.{quoted(fv.ACCOUNT)}, '-'), {i}))" for i in range(2)]
    target = [f"upper(t.{quoted(c)})" for c in (fv.TARGET_DATABASE, fv.TARGET_SCHEMA, fv.TARGET_TABLE)]
    url = fill_sql(
        fv.LINK_TEXT, account_0=account[0], account_1=account[1], database=target[0], schema=target[1], table=target[2]
    )
    columns = ", ".join(
        [*(f"m.{quoted(c)}" for c in schemas.METADATA.names), *(f"t.{quoted(n)}" for n in schemas.TAG_NAMES)]
    )
    return (
        f"SELECT {columns}, "
        f"CASE WHEN m.{quoted(fv.SYNC_STATUS)} = {sql_literal(fv.STATUS_SUCCESS)} THEN {url} END AS {quoted(fv.LINK)} "
        f"FROM {metadata} m "
        f"LEFT JOIN (SELECT xxhash64({keys}) AS key_hash, {keys}, {pivot} FROM {tags} "
        f"WHERE tag_name IN ({kept}) GROUP BY xxhash64({keys}), {keys}) t "
        f"ON xxhash64({names}) = t.key_hash AND {same}"
    )


def create_view(spark: SparkSession, name: str, metadata: str, tags: str, comment: str = "") -> None:
    """Store the enriched view in the catalog, in place of an older definition. All names are quoted and full."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT {sql_literal(comment)} AS {view_text(metadata, tags)}")


def register_view(view: DataFrame, name: str) -> DataFrame:
    """Make the view readable by SQL, replacing an older definition."""
    view.createOrReplaceTempView(name)
    return view.sparkSession.table(name)
