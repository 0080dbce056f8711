"""Temporal join of captures with dated block lists, in DataFrame expressions only.

An entry of a list holds from its date until the next entry for the same
pattern: dated entries become intervals. Every capture is tested as of its fetch
time against the patterns that cover its address, from the most to the least
specific. Time is cut into hours: within an hour the last entry is found by a
window over captures and entries of one pattern, before it by a window over one
row per pattern and hour. So no pattern, however frequent, meets in one task,
and captures and entries are never paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hour_of(time: str) -> Column:
    """Number of the hour of a time, with or without zone."""
    return F.datediff(F.to_date(time), F.lit("1970-01-01")) * 24 + F.hour(time)


def host_of(url: Column) -> Column:
    """Host in lower case without user, port and a leading ``www.``; empty where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def patterns_of(url: Column) -> Column:
    """Patterns that cover an address, most specific first: host and first path segment, host, then each parent domain
    of two labels or more."""
    host = host_of(url)
    segment = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(labels), F.lit(2))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parents = F.filter(parents, lambda p: F.instr(p, ".") > 0)
    exact = F.when(F.char_length(segment) > 0, F.array(F.concat_ws("/", host, segment), host)).otherwise(F.array(host))
    return F.when(F.char_length(host) > 0, F.concat(exact, parents)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern``, ``action``, ``valid_from``, ``valid_to`` (exclusive, null while it still holds) from entries with
    ``pattern``, ``listed_at`` and ``action`` (block, allow or remove). Of entries of one pattern and time, block wins
    over allow and allow over remove; entries without a pattern, time or action are void."""
    rank = F.array_position(F.array(F.lit("remove"), F.lit("allow"), F.lit("block")), F.col("action"))
    known = entries.select("pattern", "listed_at", "action", rank.alias("rank")).where("rank > 0 AND pattern IS NOT NULL AND listed_at IS NOT NULL")
    one = known.groupBy("pattern", "listed_at").agg(F.max_by("action", "rank").alias("action"))
    one = one.withColumn("hour", hour_of("listed_at"))
    by_hour = one.groupBy("pattern", "hour").agg(F.min("listed_at").alias("first"))
    later = by_hour.select("pattern", "hour", F.lead("first").over(Window.partitionBy("pattern").orderBy("hour")).alias("later"))
    inside = F.lead("listed_at").over(Window.partitionBy("pattern", "hour").orderBy("listed_at"))
    return one.withColumn("next", inside).join(later, ["pattern", "hour"]).select(
        "pattern", "action", F.col("listed_at").alias("valid_from"), F.coalesce("next", "later").alias("valid_to"))


def as_of(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """Per capture ``page_id``, ``url``, ``fetched_at``, ``blocked`` and, of the most specific pattern with an entry that
    held at the fetch time and is not a removal, ``pattern``, ``action``, ``valid_from`` and ``valid_to`` (else null).

    A capture without a time or without a host meets no entry and is not blocked; an entry counts from its very time.
    Repeated captures come back as often as they stand there; null ids are kept; without entries nothing is blocked.
    Other columns are not read.
    """
    listed = intervals(entries)
    entry = F.struct("action", "pattern", "valid_from", "valid_to")
    own = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched_at"))
    own = own.groupBy("page_id", "url", "fetched_at").agg(F.count("*").cast("int").alias("copies"))
    tested = own.where("fetched_at IS NOT NULL").select(
        "page_id", "url", "fetched_at", F.posexplode(patterns_of(F.col("url"))).alias("level", "pattern"))
    marks = listed.select("pattern", hour_of("valid_from").alias("hour"), F.col("valid_from").alias("at"), F.lit(0).alias("kind"), entry.alias("entry"))
    asks = tested.select("pattern", hour_of("fetched_at").alias("hour"), F.col("fetched_at").alias("at"), F.lit(1).alias("kind"),
                         "page_id", "url", "fetched_at", "level")
    both = marks.unionByName(asks, allowMissingColumns=True)
    so_far = Window.partitionBy("pattern", "hour").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_hour = both.withColumn("found", F.last("entry", ignorenulls=True).over(so_far)).where("kind = 1")
    state = both.groupBy("pattern", "hour").agg(F.max_by("entry", F.when(F.col("kind") == 0, F.col("at"))).alias("last"))
    before = Window.partitionBy("pattern").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    carried = state.select("pattern", "hour", F.last("last", ignorenulls=True).over(before).alias("carried"))
    answered = in_hour.join(carried, ["pattern", "hour"]).select(
        "page_id", "url", "fetched_at", "level", F.coalesce("found", "carried").alias("held")).where("held.action <> 'remove'")
    best = answered.groupBy("page_id", "url", "fetched_at").agg(F.min_by("held", "level").alias("held"))
    same = [own[c].eqNullSafe(best[c]) for c in ("page_id", "url", "fetched_at")]
    return own.join(best, same, "left").select(
        own["page_id"], own["url"], own["fetched_at"], F.coalesce(F.col("held.action") == "block", F.lit(False)).alias("blocked"),
        "held.pattern", "held.action", "held.valid_from", "held.valid_to",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")
