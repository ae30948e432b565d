"""URL filters whose lists change: an as-of join of captures to dated entries.

A list entry says that from `since` on a pattern (a host, a parent domain, or a
host with its first path segment) is blocked or allowed. The entries of a
pattern become validity intervals, each closed by the next one; of entries with
the same time the blocking one holds. A capture asks for every pattern that
its URL matches; of the patterns with an entry that is active at fetch time the
most specific decides, and without any the capture is allowed.

Captures are reduced to distinct (patterns, time) before they are shuffled, and
intervals are laid out over time slots, so that a host with a third of all
captures is dealt out by slot; a capture meets at most one interval of a
pattern. URLs are split by expressions, without Python. Null or unparsable URLs
have no pattern and are allowed with nulls; a null time sees no entry. Entries
without pattern or time are left out. Every row of captures is returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days in a time slot.
SLOT = 30


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user, port and final dot; empty where there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*[^/?#:@.])", 1))


def segment_of(url: Column) -> Column:
    """First path segment; empty where there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)


def patterns_of(host: Column, segment: Column) -> Column:
    """array<struct<depth, pattern>> of the patterns of a URL; a greater depth is more specific."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.when(
        n >= 2,
        F.transform(F.sequence(F.lit(2), n), lambda k: F.struct(k.cast("int").alias("depth"), F.array_join(F.slice(labels, n - k + 1, k), ".").alias("pattern"))),
    ).otherwise(F.array(F.struct(F.lit(1).alias("depth"), host.alias("pattern"))))
    whole = F.struct((n + 1).cast("int").alias("depth"), F.concat(host, F.lit("/"), segment).alias("pattern"))
    return F.when(host == "", F.array().cast("array<struct<depth:int,pattern:string>>")).when(segment == "", suffixes).otherwise(F.concat(suffixes, F.array(whole)))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, since, until, blocked) from (pattern, since, blocked); until is null for the last."""
    one = entries.filter("pattern is not null and since is not null").groupBy("pattern", "since").agg(F.max(F.coalesce("blocked", F.lit(False))).alias("blocked"))
    return one.withColumn("until", F.lead("since").over(Window.partitionBy("pattern").orderBy("since")))


def decide(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """captures with (host, blocked, pattern, since, until) added, `pattern` and the interval of the entry that decides.

    Columns of those names are replaced.
    """
    own = [c for c in captures.columns if c not in ("host", "blocked", "pattern", "since", "until")]
    slot = lambda t: F.floor(F.unix_seconds(t.cast("timestamp")) / (86400 * SLOT))
    rows = captures.select(*own, host_of(F.coalesce(F.col(url_col), F.lit(""))).alias("host"), segment_of(F.coalesce(F.col(url_col), F.lit(""))).alias("~segment"))
    asked = rows.select("host", "~segment", F.col(time_col).alias("~time")).distinct()
    asks = asked.filter(F.col("~time").isNotNull()).select("*", slot(F.col("~time")).alias("~slot"), F.inline(patterns_of(F.col("host"), F.col("~segment"))))
    span = asked.agg(F.min(slot(F.col("~time"))).alias("first"), F.max(slot(F.col("~time"))).alias("last"))
    valid = intervals(entries).crossJoin(F.broadcast(span))  # one row
    valid = valid.withColumn("from", F.greatest(slot(F.col("since")), F.col("first"))).withColumn("to", F.least(F.coalesce(slot(F.col("until")), F.col("last")), F.col("last")))
    valid = valid.filter(F.col("from") <= F.col("to")).select("pattern", "since", "until", "blocked", F.explode(F.sequence("from", "to")).alias("~slot"))
    met = asks.join(valid, ["pattern", "~slot"]).filter((F.col("since") <= F.col("~time")) & (F.col("until").isNull() | (F.col("~time") < F.col("until"))))
    best = met.groupBy("host", "~segment", "~time").agg(F.max_by(F.struct("blocked", "pattern", "since", "until"), "depth").alias("~best"))
    joined = rows.join(best.withColumnRenamed("~time", time_col), ["host", "~segment", time_col], "left")
    return joined.select(*own, "host", F.coalesce(F.col("~best.blocked"), F.lit(False)).alias("blocked"), F.col("~best.pattern").alias("pattern"), F.col("~best.since").alias("since"), F.col("~best.until").alias("until"))


# The tables have no list and no fetch time: the query derives both from their rows.


def _digest(text: Column, at: int) -> Column:
    """16 bits of the text's MD5, from hex digit `at` on."""
    return F.conv(F.substring(F.md5(text), at, 4), 16, 10).cast("long")


EPOCH = "2024-01-01 00:00:00"


def derived_captures(pages: DataFrame) -> DataFrame:
    """Each page is fetched at a second of 2024 that its id gives."""
    second = F.pmod(F.coalesce("page_id", F.lit(0)) * 7919 * 3600, F.lit(366 * 86400))
    return pages.select("page_id", "url", F.timestamp_seconds(F.unix_seconds(F.lit(EPOCH).cast("timestamp")) + second).alias("fetched"))


def derived_entries(captures: DataFrame) -> DataFrame:
    """A third of the hosts is blocked on some day and allowed again later, a quarter of the parent domains and an eighth of the sections likewise."""
    host, segment = host_of(F.coalesce("url", F.lit(""))), segment_of(F.coalesce("url", F.lit("")))
    seen = captures.select(host.alias("host"), segment.alias("segment")).filter("host <> ''").distinct()
    parent = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    named = F.array(
        F.struct(F.col("host").alias("pattern"), F.lit(3).alias("one_in")),
        F.struct(parent.alias("pattern"), F.lit(4).alias("one_in")),
        F.struct(F.concat("host", F.lit("/"), "segment").alias("pattern"), F.lit(8).alias("one_in")),
    )
    listed = seen.select(F.inline(named)).filter("pattern <> '' and pattern not like '%/'").groupBy("pattern").agg(F.min("one_in").alias("one_in"))
    listed = listed.filter(F.pmod(_digest(F.col("pattern"), 1), F.col("one_in")) == 0)
    start = F.unix_seconds(F.lit(EPOCH).cast("timestamp"))
    on = start + F.pmod(_digest(F.col("pattern"), 5), F.lit(300)) * 86400
    off = on + (F.lit(1) + F.pmod(_digest(F.col("pattern"), 9), F.lit(90))) * 86400
    return listed.select(
        "pattern", F.inline(F.array(F.struct(F.timestamp_seconds(on).alias("since"), F.lit(True).alias("blocked")), F.struct(F.timestamp_seconds(off).alias("since"), F.lit(False).alias("blocked"))))
    )
