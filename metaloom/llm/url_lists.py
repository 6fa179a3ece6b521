"""URL filters: captures joined with dated list entries as of the day they were fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from metaloom.operators.joins import skew_safe_join

BLOCK, ALLOW, REMOVE = "block", "allow", "remove"


def url_host(url: Column) -> Column:
    """The lower-cased host without user, port and a final dot; empty if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.regexp_replace(host, r"\.$", ""))


def url_path(url: Column) -> Column:
    """The path, without query and fragment; empty if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def url_patterns(host: Column, path: Column) -> Column:
    """All patterns that match a URL: its host, every parent domain, and the host with each leading part of the path."""
    labels, parts = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda x: x != "")
    n, m = F.size(labels), F.size(parts)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    places = F.when(
        m > 0,
        F.transform(
            F.sequence(F.lit(1), m), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.concat(domains, places)).otherwise(F.array().cast("array<string>"))


def entry_intervals(entries: DataFrame) -> DataFrame:
    """``list_name, pattern, action, listed_on, until``: each entry holds until the next one of its list and pattern.

    Of entries of one day, block counts before allow and allow before remove. A remove entry only ends others.
    """
    strength = F.when(F.col("action") == BLOCK, 2).when(F.col("action") == ALLOW, 1).otherwise(0)
    usable = entries.filter("list_name IS NOT NULL AND pattern IS NOT NULL AND listed_on IS NOT NULL")
    daily = usable.groupBy("list_name", "pattern", "listed_on").agg(F.max_by("action", strength).alias("action"))
    order = Window.partitionBy("list_name", "pattern").orderBy("listed_on")
    dated = daily.withColumn("until", F.lead("listed_on").over(order))
    return dated.filter(F.col("action").isin(BLOCK, ALLOW))


def url_verdicts(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_on: str = "fetched_on") -> DataFrame:
    """Every row of ``captures`` with the verdict of the list entries that held on the day it was fetched.

    ``entries`` has ``list_name, pattern, action, listed_on``; a pattern is a host or domain (with all below it), or a
    host with the leading parts of a path. Adds ``host, verdict`` (``block``, ``allow``, ``none``), ``pattern``,
    ``list_name`` and ``listed_on`` of the entry that decides: the longest pattern, then block before allow, then the
    newest, then the last list by name. Columns of ``captures`` of these names are replaced.

    Entries become validity intervals, which are dealt to the calendar months they touch; captures meet the entries
    of their patterns and month by an equi-join, and days are compared within it. Each URL and day is looked up
    once, so copies of a capture cost nothing, and a domain that a third of all captures share is split by the join.

    A null or malformed URL and a null day have no entries and the verdict ``none``. Entries with nulls in list,
    pattern or day are ignored, and repeated entries count once. Empty tables give no rows or no matches.
    """
    added = ["host", "verdict", "pattern", "list_name", "listed_on"]
    rows = captures.drop(*added).withColumn("host", F.coalesce(url_host(F.col(url)), F.lit("")))
    asked = rows.select(F.col(url).alias("_url"), F.col(fetched_on).alias("_day"), "host").filter(
        "_url IS NOT NULL AND _day IS NOT NULL AND host != ''"
    )
    asked = asked.distinct()
    reach = asked.agg(F.min("_day").alias("first"), F.max("_day").alias("last"))
    keys = asked.select(
        "_url",
        "_day",
        F.trunc("_day", "month").alias("month"),
        F.explode(F.array_distinct(url_patterns(F.col("host"), url_path(F.col("_url"))))).alias("pattern"),
    )
    # one row of two days: the span of the captures, beyond which no entry needs to be dealt
    spans = entry_intervals(entries).join(F.broadcast(reach), F.lit(True)).filter(
        "listed_on <= last AND (until IS NULL OR until > first)"
    )
    months = F.sequence(
        F.trunc(F.greatest("listed_on", "first"), "month"),
        F.trunc(F.least(F.coalesce(F.date_sub("until", 1), F.col("last")), F.col("last")), "month"),
        F.expr("interval 1 month"),
    )
    dealt = spans.select("list_name", "pattern", "action", "listed_on", "until", F.explode(months).alias("month"))
    met = skew_safe_join(keys, dealt, ["pattern", "month"], "inner")
    active = met.filter("listed_on <= _day AND (until IS NULL OR _day < until)")
    rank = F.struct(
        F.length("pattern").alias("size"),
        (F.col("action") == BLOCK).cast("int").alias("blocks"),
        "listed_on",
        "list_name",
        "pattern",
    )
    best = active.groupBy("_url", "_day").agg(F.max(rank).alias("best"))
    verdict = F.when(F.col("best.blocks") == 1, BLOCK).when(F.col("best.blocks") == 0, ALLOW).otherwise("none")
    decided = best.select(
        F.col("_url").alias(url),
        F.col("_day").alias(fetched_on),
        verdict.alias("verdict"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.list_name").alias("list_name"),
        F.col("best.listed_on").alias("listed_on"),
    )
    known = F.col(url).isNotNull() & F.col(fetched_on).isNotNull()
    found = skew_safe_join(rows.filter(known), decided, [url, fetched_on], "left")
    found = found.withColumn("verdict", F.coalesce("verdict", F.lit("none")))
    return found.unionByName(rows.filter(~known).withColumn("verdict", F.lit("none")), allowMissingColumns=True)
