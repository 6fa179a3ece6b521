"""Listing pages: JSON documents, one per row, that name schemas and tables.

A listing may span many pages and every page is a row, so a paged listing is read whole.
A body that is no listing (an error document, or no JSON) becomes a reject row, which an
empty listing is not. Of a listing with nameless entries the named ones count, and the page
is reported. Where pages come with the token they were asked for, the chain of a listing's
pages is checked, and what breaks it is reported as well.

Lists are unfolded with their NULLs, which are filtered out afterwards: for a plain unfolding
Spark first filters out empty lists, and so parses each body several times.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from metaloom import schemas
from metaloom.session import stage

#: Optional column of landed pages: the token a page was asked for with, NULL for a listing's first page.
PAGE_TOKEN = "page_token"
#: File name, without its ending, of a first page.
FIRST_PAGE = "first"


def _read_pages(spark: SparkSession, path: str, columns: StructType, tokens: bool) -> DataFrame:
    keys = [f for f in columns.fields if f.name != "body"]
    layout = StructType([StructField("value", StringType()), *keys])
    files = spark.read.schema(layout).text(path, wholetext=True).withColumnRenamed("value", "body")
    if not tokens:
        return files.select(*columns.names)
    name = F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")
    name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))  # Spark shows the name as part of a URL
    return files.select(*columns.names, F.nullif(F.url_decode(name), F.lit(FIRST_PAGE)).alias(PAGE_TOKEN))


def read_schema_pages(spark: SparkSession, path: str, tokens: bool = False) -> DataFrame:
    """Pages landed as files, one document each, below ``catalog_name=<name>/``.

    With ``tokens``, a file is named by the URL-encoded token its page was asked for with, or ``first``, and the
    pages come with it, so that a listing's chain can be checked.
    """
    return _read_pages(spark, path, schemas.SCHEMA_PAGES, tokens)


def read_table_pages(spark: SparkSession, path: str, tokens: bool = False) -> DataFrame:
    """Pages landed as files below ``catalog_name=<name>/schema_name=<name>/``; ``tokens`` as above."""
    return _read_pages(spark, path, schemas.TABLE_PAGES, tokens)


def _documents(document: StructType) -> Column:
    """A body's documents. Read as an array, so that trailing text makes it unreadable."""
    body = F.concat(F.lit("["), F.col("body"), F.lit("]"))
    return F.from_json(body, ArrayType(document))


def list_schemas(pages: DataFrame) -> DataFrame:
    """Schemas named by pages: ``catalog_name, schema_name``, each once.

    Of a multi-level namespace the first level counts, so levels below repeat a schema.
    """
    return (
        pages.select("catalog_name", F.explode_outer(_documents(schemas.SCHEMA_DOCUMENT)).alias("d"))
        .select("catalog_name", F.explode_outer("d.namespaces").alias("namespace"))
        .select("catalog_name", F.get("namespace", F.lit(0)).alias("schema_name"))
        .filter(F.col("schema_name").isNotNull())
        .distinct()
    )


def list_tables(pages: DataFrame) -> DataFrame:
    """Tables named by pages: ``catalog_name, schema_name, table_name``, each once."""
    key = ("catalog_name", "schema_name")
    return (
        pages.select(*key, F.explode_outer(_documents(schemas.TABLE_DOCUMENT)).alias("d"))
        .select(*key, F.explode_outer("d.identifiers").alias("t"))
        .select(*key, F.col("t.name").alias("table_name"))
        .filter(F.col("table_name").isNotNull())
        .distinct()
    )


def _rejected(
    pages: DataFrame,
    document: StructType,
    listed: str,
    entry_name: Callable[[Column], Column],
    schema_name: Column,
) -> DataFrame:
    def fault(d: Column) -> Column:
        """0 without a list, 1 with an entry that has no name, else 2."""
        unnamed = F.exists(d[listed], lambda entry: entry_name(entry).isNull())
        return F.when(d[listed].isNull(), 0).when(unnamed, 1).otherwise(2)

    worst = F.coalesce(F.array_min(F.transform(_documents(document), fault)), F.lit(0))
    text = F.when(F.col("fault") == 0, "page is no listing: ").otherwise("page has a nameless entry: ")
    return (
        pages.withColumn("fault", worst)
        .filter(F.col("fault") < 2)
        .select(
            "catalog_name",
            schema_name.alias("schema_name"),
            F.lit(None).cast("string").alias("table_name"),
            F.concat(text, F.coalesce("body", F.lit("NULL"))).alias("reason"),
        )
    )


def rejected_schema_pages(pages: DataFrame) -> DataFrame:
    """Pages that could not be read, or not wholly."""
    return _rejected(
        pages,
        schemas.SCHEMA_DOCUMENT,
        "namespaces",
        lambda namespace: F.get(namespace, F.lit(0)),
        F.lit(None).cast("string"),
    )


def rejected_table_pages(pages: DataFrame) -> DataFrame:
    """Pages that could not be read, or not wholly."""
    return _rejected(
        pages,
        schemas.TABLE_DOCUMENT,
        "identifiers",
        lambda identifier: identifier["name"],
        F.col("schema_name"),
    )


def broken_schema_listings(pages: DataFrame) -> DataFrame:
    """What breaks the chain of pages of a catalog's listing of schemas."""
    return _broken(pages, schemas.SCHEMA_DOCUMENT, ("catalog_name",))


def broken_table_listings(pages: DataFrame) -> DataFrame:
    """What breaks the chain of pages of a schema's listing of tables."""
    return _broken(pages, schemas.TABLE_DOCUMENT, ("catalog_name", "schema_name"))


def _broken(pages: DataFrame, document: StructType, listing: Sequence[str]) -> DataFrame:
    """Reject rows of listings whose pages are not one chain from a first page to a last one.

    A page holds the token of the next one, and ``PAGE_TOKEN`` says which token it was asked for with, so pages are
    a graph: every token named must have a page, every page but the first must be named, each by one page, a page must
    not name several, and no page may lead back to itself. Pages landed twice count once; an empty token is none, and
    so is the token of an unreadable page. Pages are reduced to their tokens first. Cycles are found by pointer
    doubling, a join of tokens for each doubling of the longest chain, over the pages whose chain has not ended yet.
    """
    keys = [F.col(k) for k in listing]
    following = F.get(_documents(document), F.lit(0))["next-page-token"]
    nodes = pages.select(
        *keys, F.nullif(F.col(PAGE_TOKEN), F.lit("")).alias("token"), F.nullif(following, F.lit("")).alias("next")
    )
    nodes = stage(nodes.distinct(), "pages")
    named = nodes.filter("next IS NOT NULL").select(*keys, "token", "next")
    asked = nodes.filter("token IS NOT NULL").select(*keys, "token").distinct()
    targets = named.groupBy(*keys, "next").agg(F.count_distinct(F.struct("token")).alias("n"))
    sources = nodes.groupBy(*keys, "token").agg(F.count("next").alias("n"), F.min("next").alias("next"))
    heads = nodes.filter("token IS NULL").select(*keys).distinct()
    as_token = targets.select(*keys, F.col("next").alias("token"), "n")
    own = [*listing, "token"]

    def page(token: str = "token") -> Column:
        return F.coalesce(F.concat(F.lit("page "), F.col(token)), F.lit("the first page"))

    found = [
        as_token.join(asked, own, "left_anti").select(*keys, F.concat(page(), F.lit(" is missing")).alias("reason")),
        nodes.select(*keys).distinct().join(heads, list(listing), "left_anti").select(
            *keys, F.lit("the first page is missing").alias("reason")
        ),
        asked.join(as_token, own, "left_anti").select(*keys, F.concat(F.lit("no page leads to "), page()).alias("reason")),
        as_token.filter("n > 1").select(*keys, F.concat(F.lit("several pages lead to "), page()).alias("reason")),
        sources.filter("n > 1").select(*keys, F.concat(page(), F.lit(" leads to several pages")).alias("reason")),
        _cycles(sources.filter("next IS NOT NULL").select(*keys, "token", "next"), listing).select(
            *keys, F.concat(page(), F.lit(" leads back to itself")).alias("reason")
        ),
    ]
    rows = reduce(DataFrame.unionByName, found)
    schema_name = F.col("schema_name") if "schema_name" in listing else F.lit(None).cast("string").alias("schema_name")
    return rows.select(
        "catalog_name", schema_name, F.lit(None).cast("string").alias("table_name"), F.concat(F.lit("listing: "), "reason").alias("reason")
    )


def _cycles(edges: DataFrame, listing: Sequence[str]) -> DataFrame:
    """``*listing, token`` of pages that lead back to themselves; each page leads to one other.

    After round k a page holds where 2^k steps lead. Pages whose way has ended drop out. Those left when the steps
    outnumber the pages of any listing go round, and where they have got to is all of their cycles.
    """
    pages = edges.groupBy(*listing).count().agg(F.max("count")).first()[0] or 0
    left = stage(edges.filter("token IS NOT NULL"), "steps")
    steps = 1
    while steps <= pages and not left.isEmpty():
        beyond = left.select(*listing, F.col("token").alias("next"), F.col("next").alias("after"))
        left = left.join(beyond, [*listing, "next"]).select(*listing, "token", F.col("after").alias("next"))
        left, steps = stage(left, "steps"), steps * 2
    return left.select(*listing, F.col("next").alias("token")).distinct()
