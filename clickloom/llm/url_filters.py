"""URL filters whose lists change over time, by an as-of join.

List entries are dated: an entry adds a pattern to a list, or takes it off. They
become validity intervals, and every capture is judged by the intervals that
contain its fetch date. A pattern is a domain, which stands for its subdomains
too, or a section, which is a host with the first part of the path.

Entries of one (list, pattern) are first reduced to one per day, so a pattern
has no more intervals than days, however often it is listed. Its intervals lie
side by side in one row; a capture meets one row for each of its patterns, and
the date is looked up there. No capture meets a pattern's intervals one by one.

All of it is DataFrame expressions: no Python runs on the executors.

Defined results: an entry with a null in list, pattern, day or action is left
out; on a day with both, adding wins. A capture with a null or unreadable URL, a
host over 253 characters, or no fetch date matches nothing and is not blocked.
Repeated captures are answered as often as they occur. Of several matches the first by
list, pattern and day is named. Without captures there are no rows; without entries
nothing is blocked. Other columns of either table are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: scheme, user, host, port, first part of the path
PARTS = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)(?::[0-9]*)?(?:/([^/?#]*))?"
MOST_HOST = 253


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.lower(url), PARTS, 1)
    return F.when((found != "") & (F.length(found) <= MOST_HOST), found)


def patterns_of(url: Column) -> Column:
    """The capture's host, its parent domains, and its section, as patterns."""
    host, section = host_of(url), F.regexp_extract(F.lower(url), PARTS, 2)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, n - i + 1), ".")))
    sections = F.when(section != "", F.array(F.concat(F.lit("section:"), host, F.lit("/"), section))).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.concat(domains, sections)).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list, pattern, valid_from, valid_to) of entries (list, pattern, day, added).

    ``valid_to`` is the first day on which the pattern is off the list; null: still listed.
    """
    present = F.col("list").isNotNull() & F.col("pattern").isNotNull() & F.col("day").isNotNull() & F.col("added").isNotNull()
    daily = entries.where(present).groupBy("list", "pattern", "day").agg(F.max(F.col("added").cast("int")).alias("on"))
    over_days = Window.partitionBy("list", "pattern").orderBy("day")
    changes = daily.withColumn("before", F.coalesce(F.lag("on").over(over_days), F.lit(0))).where(F.col("before") != F.col("on"))
    return changes.withColumn("valid_to", F.lead("day").over(over_days)).where("on = 1").select(
        "list", "pattern", F.col("day").alias("valid_from"), "valid_to"
    )


def judge(captures: DataFrame, entries: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Rows (id, url, fetched, host, n_matches, matched, listed_since, blocked), one per capture of (id, url, fetched).

    ``matched`` is the first match in order of (list, pattern), ``listed_since`` its interval's start.
    """
    spans = validity(entries).groupBy("pattern").agg(F.collect_list(F.struct("list", "valid_from", "valid_to")).alias("spans"))
    rows = captures.groupBy(id_col, "url", "fetched").agg(F.count(F.lit(1)).alias("_times"))
    keys = rows.withColumn("pattern", F.explode_outer(patterns_of(F.col("url"))))
    day = F.col("fetched").cast("date")
    active = F.filter("spans", lambda s: (s["valid_from"] <= day) & (s["valid_to"].isNull() | (day < s["valid_to"])))
    hits = keys.join(spans, "pattern", "left").select(
        id_col, "url", "fetched", "_times",
        F.transform(active, lambda s: F.struct(s["list"].alias("list"), F.col("pattern").alias("pattern"), s["valid_from"].alias("valid_from"))).alias("hits"),
    )
    first = F.min(F.array_min("hits"))
    judged = hits.groupBy(id_col, "url", "fetched", "_times").agg(
        F.coalesce(F.sum(F.size("hits")), F.lit(0)).cast("long").alias("n_matches"), first.alias("_first")
    )
    return judged.select(
        id_col, "url", "fetched", host_of(F.col("url")).alias("host"), "n_matches",
        F.concat("_first.list", F.lit(" "), "_first.pattern").alias("matched"), F.col("_first.valid_from").alias("listed_since"),
        (F.col("n_matches") > 0).alias("blocked"), F.explode(F.array_repeat(F.lit(1), F.col("_times").cast("int"))).alias("_one"),
    ).drop("_one")
