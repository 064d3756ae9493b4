"""URL filter by dated lists (operator 9).

A list is a log of entries: from a time on, a pattern is blocked, allowed or
dropped from the list. Entries of one pattern, in order of time, become validity
intervals; each lasts until the pattern's next entry. A capture of a URL meets
the entries that were active when it was fetched, an as-of join.

A pattern is a host, which holds for its subdomains too, or a host with the
beginning of a path, up to a slash or the end. Of the active entries the most
specific (the longest pattern) decides; without one the capture passes.

Intervals are cut at the borders of time slices, and captures are joined by
(pattern, slice): a pattern that holds a third of all captures, and one whose
entries change daily for years, are spread over their slices, and a capture only
meets the entries of its own slice. Everything is SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a time slice.
SLICE = 28 * 86_400
FOREVER = "9999-12-31 00:00:00"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and final dot; null if there is none."""
    h = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    h = F.regexp_replace(h, r"\.$", "")
    return F.when(h != "", h)


def path_of(url: Column) -> Column:
    """Path of a URL without query and fragment, empty if there is none."""
    return F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)


def patterns(host: Column, path: Column) -> Column:
    """Every pattern that may hold for a URL: its host's suffixes, and the host with each beginning of its path."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    count = F.size(parts)
    paths = F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))).otherwise(F.expr("array()").cast("array<string>"))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(suffixes, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern, action, valid_from, valid_to`` of ``pattern, action, at``; the end is exclusive.

    ``action`` is ``block``, ``allow`` or ``drop``; a dropped pattern has no
    interval until it is listed again. Of entries of one pattern and time,
    block goes before allow and allow before drop; repeated entries count once.
    Entries with a null pattern or time, or another action, are left out.
    """
    e = entries.select(F.lower("pattern").alias("pattern"), "action", F.col("at").cast("timestamp_ntz").alias("valid_from"))
    e = e.where("pattern IS NOT NULL AND valid_from IS NOT NULL AND action IN ('block', 'allow', 'drop')")
    rank = F.when(F.col("action") == "block", 0).when(F.col("action") == "allow", 1).otherwise(2)
    e = e.groupBy("pattern", "valid_from").agg(F.min_by("action", rank).alias("action"))
    nxt = F.lead("valid_from").over(Window.partitionBy("pattern").orderBy("valid_from"))
    e = e.withColumn("valid_to", F.coalesce(nxt, F.lit(FOREVER).cast("timestamp_ntz")))
    return e.where("action != 'drop'").select("pattern", "action", "valid_from", "valid_to")


def slice_of(at: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(at.cast("timestamp")) / seconds)


def judge(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at", seconds: int = SLICE) -> DataFrame:
    """``id, url, fetched_at, pattern, action, valid_from, blocked`` for each capture.

    ``pattern, action, valid_from`` tell the deciding entry, null if none is
    active. A capture without a URL, host or time meets no entry and passes.
    Repeated rows each get a row. Empty lists block nothing; an empty table gives
    none. Other columns are ignored.
    """
    c = captures.select(captures[id_col].alias("id"), captures[url_col].alias("url"), captures[time_col].cast("timestamp_ntz").alias("fetched_at"))
    # one row for each capture; repeats are counted, so that the join's rows find their way back
    c = c.groupBy("id", "url", "fetched_at").agg(F.count("*").alias("times"))
    spans = intervals(entries)
    # an interval without an end reaches to the last capture's slice: one value, not rows, reaches the driver
    bounds = c.agg(F.min(slice_of(F.col("fetched_at"), seconds)).alias("lo"), F.max(slice_of(F.col("fetched_at"), seconds)).alias("hi")).first()
    lo, hi = (bounds["lo"], bounds["hi"]) if bounds["lo"] is not None else (0, -1)
    first = F.greatest(slice_of(F.col("valid_from"), seconds), F.lit(lo))
    last = F.least(slice_of(F.col("valid_to"), seconds), F.lit(hi))
    spans = spans.select("*", F.explode(F.when(first <= last, F.sequence(first, last))).alias("slice"))
    keyed = c.where("fetched_at IS NOT NULL").select("id", "url", "fetched_at", slice_of(F.col("fetched_at"), seconds).alias("slice"), F.explode(patterns(host_of(F.col("url")), path_of(F.col("url")))).alias("pattern"))
    met = keyed.join(spans, ["pattern", "slice"]).where("valid_from <= fetched_at AND fetched_at < valid_to")
    best = met.groupBy("id", "url", "fetched_at").agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "valid_from")).alias("best"))
    best = best.select(F.col("id").alias("_id"), F.col("url").alias("_url"), F.col("fetched_at").alias("_at"), "best")
    out = c.join(best, F.col("id").eqNullSafe(F.col("_id")) & (F.col("url") == F.col("_url")) & (F.col("fetched_at") == F.col("_at")), "left")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return out.select(F.col("id").alias(id_col), "url", "fetched_at", "best.pattern", "best.action", "best.valid_from", F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"))


# ---------------------------------------------------------------- the query's captures and list

#: The pages carry no fetch time and no list comes with them. The query fetches page k on day k mod 365 of a year, and takes its list from the pages' own hosts.
YEAR = "2024-01-01"


def dated_captures(pages: DataFrame) -> DataFrame:
    day = F.pmod(F.col("page_id"), F.lit(365)).cast("int")
    return pages.select("page_id", "url", (F.date_add(F.lit(YEAR).cast("date"), day)).cast("timestamp_ntz").alias("fetched_at"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A list made of the pages' hosts and first directories.

    By the length of the host's name: hosts of 0 modulo 3 are blocked in
    February, dropped in June and blocked again in October; hosts of 1 modulo 3
    are blocked from April on, and each ``/en`` below is allowed from August
    on; the last three labels of hosts with a hyphen are blocked from the
    beginning.
    """
    host = host_of(F.col("url"))
    h = pages.select(host.alias("host")).where("host IS NOT NULL").distinct()
    def at(day: str) -> Column:
        return F.lit(f"{day} 00:00:00").cast("timestamp_ntz").alias("at")
    def entry(df: DataFrame, pattern: Column, action: str, day: str) -> DataFrame:
        return df.select(pattern.alias("pattern"), F.lit(action).alias("action"), at(day))
    zero, one = h.where("length(host) % 3 = 0"), h.where("length(host) % 3 = 1")
    domain = F.concat_ws(".", F.slice(F.split("host", r"\."), -3, 3))
    hyphen = h.where("host LIKE '%-%'").select(domain.alias("host")).distinct()
    parts = [
        entry(zero, F.col("host"), "block", "2024-02-01"), entry(zero, F.col("host"), "drop", "2024-06-01"), entry(zero, F.col("host"), "block", "2024-10-01"),
        entry(one, F.col("host"), "block", "2024-04-01"), entry(one, F.concat("host", F.lit("/en")), "allow", "2024-08-01"),
        entry(hyphen, F.col("host"), "block", "2024-01-01"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
