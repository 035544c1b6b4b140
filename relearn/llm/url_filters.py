"""Operator 3: URL filters as a temporal list join.

A list is a log of dated lines: an entry (a domain, or a host with leading path segments) is added or removed at a
time.  The lines of an entry become validity intervals [since, until).  Every capture (url, time of fetch) is turned
into the keys that could list it, and an as-of join evaluates them against the intervals that hold at its time.

The join is a merge by time: time is cut into at most ``BUCKETS`` stretches; in each (entry, stretch) the captures, the
starts and ends of intervals and the state that the stretch begins with stand in one order, and a running last value
gives every capture the state at its time.  Its work is that of sorting captures and interval ends, however often an entry
is toggled.  Captures of one entry and stretch are dealt to ``SALTS`` parts, each with the interval ends of its own, so a host
that many captures share spreads over tasks.  Captures are grouped before their keys are made, and what travels with a
key is a row number, not the url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relearn.llm.common import cut

BUCKETS, SALTS = 1024, 32

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))


def segments(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")


def url_keys(url: Column) -> Column:
    """Keys that could list a URL: its host and the domains above it, and the host with one, two, ... path segments.

    A text that isn't a URL with a host has no keys.
    """
    labels = F.split(host(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    path = segments(url)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(path)), lambda i: F.concat(F.lit("prefix:"), host(url), F.lit("/"), F.array_join(F.slice(path, F.lit(1), i), "/")))
    none = F.array().cast("array<string>")
    return F.when(host(url) != "", F.concat(domains, F.when(F.size(path) > 0, prefixes).otherwise(none))).otherwise(none)


def intervals(log: DataFrame) -> DataFrame:
    """``(entry, since, until)`` from lines ``(entry, at, action)``; until is null while an entry is still listed.

    Actions are ``add`` and ``remove``; of lines at one time an add counts last.  A repeated add or remove changes
    nothing, a remove before any add neither.  Lines with a null or another action are left out.
    """
    lines = log.where("entry is not null and at is not null and action in ('add', 'remove')")
    state = lines.groupBy("entry", "at").agg(F.max(F.col("action") == "add").alias("on"))
    w = Window.partitionBy("entry").orderBy("at")
    changes = state.withColumn("before", F.coalesce(F.lag("on").over(w), F.lit(False))).where(F.col("on") != F.col("before"))
    return changes.withColumn("until", F.lead("at").over(w)).where("on").select("entry", F.col("at").alias("since"), "until")


def active(keyed: DataFrame, held: DataFrame) -> DataFrame:
    """``(id, entry)``: which keys (id, entry, at) are listed at their time by the intervals ``held`` (entry, since, until)."""
    held = cut(held)
    ends = held.select("entry", F.col("since").alias("at"), F.lit(True).alias("on")).unionByName(
        held.where("until is not null").select("entry", F.col("until").alias("at"), F.lit(False).alias("on")))
    # intervals of an entry are apart, so a time has one state; an end that is also a start counts as a start
    ends = ends.groupBy("entry", "at").agg(F.max("on").alias("on"))
    span = held.agg(F.min("since").alias("lo"), F.max(F.greatest("since", F.coalesce("until", "since"))).alias("hi")).first()
    if span.lo is None:
        return keyed.select("id", "entry").where(F.lit(False))
    width = max(1, -(-(span.hi - span.lo + 1) // BUCKETS))
    bucket = F.greatest(F.lit(0).cast("long"), F.least(F.lit(BUCKETS).cast("long"), F.floor((F.col("at") - F.lit(span.lo)) / width))).alias("bucket")
    asked = keyed.where(F.col("at") >= span.lo).join(held.select("entry").distinct(), "entry", "left_semi").select("id", "entry", "at", bucket)
    ends = ends.select("entry", "at", "on", bucket)
    last = ends.groupBy("entry", "bucket").agg(F.max_by("on", "at").alias("on"))
    places = asked.select("entry", "bucket").distinct().join(last, ["entry", "bucket"], "full")
    before = Window.partitionBy("entry").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)        # BUCKETS rows an entry
    begin = places.withColumn("on", F.last("on", ignorenulls=True).over(before)).where("on is not null").select(
        "entry", F.lit(None).cast("long").alias("at"), "on", "bucket")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    states = begin.unionByName(ends.select("entry", "at", "on", "bucket")).select("*", salts).withColumn("id", F.lit(None).cast("long"))
    rows = states.unionByName(asked.withColumn("on", F.lit(None).cast("boolean")).withColumn("salt", F.pmod("id", F.lit(SALTS)).cast("int")))
    upto = Window.partitionBy("entry", "bucket", "salt").orderBy(F.col("at").asc_nulls_first(), F.col("id").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("listed", F.last("on", ignorenulls=True).over(upto)).where("id is not null and listed").select("id", "entry")


def filter_urls(captures: DataFrame, log: DataFrame) -> DataFrame:
    """``(page_id, url, fetched_at, blocked, entries)`` for every row of ``captures``.

    entries are the listed keys that hold when the page is fetched, sorted; blocked tells whether there is one.  A
    null url or time, or a text that isn't a URL, is never blocked.  Repeated rows are all returned; an empty list
    blocks nothing, an empty table gives no rows.  Other columns are left out.
    """
    key = ["page_id", "url", "fetched_at"]
    grouped = cut(captures.groupBy(*key).agg(F.count("*").alias("copies"))).withColumn("id", F.monotonically_increasing_id())
    keyed = grouped.select("id", F.explode(url_keys(F.col("url"))).alias("entry"), F.col("fetched_at").cast("long").alias("at"))
    found = active(keyed, intervals(log)).groupBy("id").agg(F.collect_set("entry").alias("found"))       # an entry per key of the url at most
    out = grouped.join(found, "id", "left").withColumn("entries", F.array_sort(F.coalesce("found", F.array().cast("array<string>"))))
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select(*key, (F.size("entries") > 0).alias("blocked"), "entries"))
