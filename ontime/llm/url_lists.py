"""URL filters by a temporal list join (native).

A list is a history of dated changes: (list_name, verdict, key, action, at) with verdict ``block`` or ``allow``, action
``add`` or ``remove``, and a key that is a host, any domain above it, or a host with the first segments of a path. Changes
become validity intervals, and every capture is joined as of its fetch time with the entries of its keys.

The join is an equality on key and month, with the interval as a further condition: an interval is copied to the months it touches
between the first and the last fetch, so a key with a long history or many captures is never one group, and what the
join emits is one row per key that is active. Captures are reduced to distinct (URL, time) first, and verdicts
joined back to all rows. Of a long path only the leading parts with as many segments as some listed key become keys. The end of an interval is found within a month, and across months from the first change of each, so
no key's whole history is sorted in one task.

Of the active entries the longest key decides; of equal keys an allowing list wins over a blocking one, then the first name.
Of changes of a key at the same moment a removal wins.

Defined results: a null URL or time and a URL without a host have no keys and are kept; changes with a null in any column
are void; repeated changes and captures count once and every capture row gets a verdict; empty tables give no verdicts
or no rows; columns other than those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import fresh, named

HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case without a final dot; empty if there is none."""
    return F.lower(F.regexp_replace(F.regexp_extract(url, HOST, 1), r"\.$", ""))


def path_depths(changes: DataFrame) -> list[int]:
    """The numbers of path segments that listed keys have: other leading parts of a path cannot match. Few, as lists are made."""
    depth = (F.length("key") - F.length(F.replace("key", F.lit("/"), F.lit("")))).alias("depth")
    return sorted(r["depth"] for r in changes.select(depth).distinct().where("depth > 0").collect())


def keys_of(url: Column, depths: list[int] | None = None) -> Column:
    """The host, every domain above it but the topmost, and the host with the leading parts of the path: of all depths, or of some."""
    labels = F.split(host_of(url), r"\.")
    n = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    segments = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    lengths = F.sequence(F.lit(1), F.size(segments)) if depths is None else F.filter(
        F.array(*map(F.lit, depths)).cast("array<int>"), lambda d: d <= F.size(segments))
    paths = F.when(F.size(segments) > 0, F.transform(
        lengths, lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/"))))
    keys = F.concat(domains, F.coalesce(paths, F.array().cast("array<string>")))
    return F.when(host_of(url) != "", keys).otherwise(F.array().cast("array<string>"))


def _month(at: Column) -> Column:
    return F.year(at) * 12 + F.month(at)


def intervals(changes: DataFrame) -> DataFrame:
    """(list_name, verdict, key, since, until): when each key is on a list; ``until`` is excluded and null if open."""
    own = ["list_name", "verdict", "key"]
    sound = changes.select(*own, "action", F.col("at").cast("timestamp").alias("at")).dropna()
    moments = sound.groupBy(*own, "at").agg(F.max("action").alias("action"))  # remove > add
    dated = moments.withColumn("month", _month(F.col("at")))
    firsts = dated.groupBy(*own, "month").agg(F.min("at").alias("first"))
    later = firsts.select(*own, "month", F.lead("first").over(Window.partitionBy(own).orderBy("month")).alias("next_month"))
    inside = dated.withColumn("next", F.lead("at").over(Window.partitionBy(*own, "month").orderBy("at")))
    ended = inside.join(later, [*own, "month"]).select(*own, "action", F.col("at").alias("since"), F.coalesce("next", "next_month").alias("until"))
    return ended.where(F.col("action") == "add").drop("action")


def verdicts(captures: DataFrame, changes: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """``captures`` with kept, list_name, list_key and listed_since of the entry that decides (null where none is active).

    New columns take another name where ``captures`` has theirs already.
    """
    asked = captures.select(named(url_col).alias("url"), named(time_col).cast("timestamp").alias("fetched")).dropna().distinct()
    wanted = asked.select("url", "fetched", _month(F.col("fetched")).alias("month"), F.explode(F.array_distinct(keys_of(F.col("url"), path_depths(changes)))).alias("key"))
    bounds = asked.agg(F.min("fetched").alias("first"), F.max("fetched").alias("last"))
    spans = (
        intervals(changes).crossJoin(F.broadcast(bounds))  # one row
        .where((F.col("since") <= F.col("last")) & (F.coalesce("until", F.lit("9999-01-01").cast("timestamp")) > F.col("first")))
        .withColumn("month", F.explode(F.sequence(
            _month(F.greatest("since", "first")), _month(F.least(F.coalesce("until", "last"), F.col("last"))))))
    )
    active = wanted.join(spans, ["key", "month"]).where(
        (F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    rank = F.struct(-F.length("key"), F.col("verdict"), F.col("list_name"), F.col("key"), F.col("since"))  # allow < block
    best = active.groupBy("url", "fetched").agg(F.min(rank).alias("best"))
    judged = best.select(F.col("url").alias(fresh(captures, "judged_url")), F.col("fetched").alias(fresh(captures, "judged_time")), "best")
    found = fresh(captures, "best")
    judged = judged.withColumnRenamed("best", found)
    names = {fresh(captures, k): v for k, v in {
        "kept": F.coalesce(F.col(f"{found}.verdict") != "block", F.lit(True)), "list_name": F.col(f"{found}.list_name"),
        "list_key": F.col(f"{found}.key"), "listed_since": F.col(f"{found}.since")}.items()}
    url, time, _ = judged.columns
    rows = captures.join(judged, (named(url_col) == F.col(url)) & (named(time_col).cast("timestamp") == F.col(time)), "left")
    return rows.withColumns(names).select(*[named(c) for c in captures.columns], *names)
