"""Cluster profiles, cross-tabs, insight text and session look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import as_long, half_even, parsed_id
from clickloom.functions.quantiles import exact_quantiles
from clickloom.schema import (
    CLUSTER,
    KEY,
    PROFILE_FEATURES,
    numeric_columns,
    require_columns,
)



def cluster_sizes(df: DataFrame, label: str = CLUSTER) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("size")).orderBy(label)


def rounded_profile(df: DataFrame, columns: Sequence[str] = PROFILE_FEATURES, label: str = CLUSTER) -> DataFrame:
    """Means to two digits and the size of each cluster, in one aggregation."""
    return df.groupBy(label).agg(
        *[half_even(F.avg(c)).alias(c) for c in columns], F.count(F.lit(1)).alias("size")
    )


def top_per_cluster(df: DataFrame, column: str, n: int = 3, label: str = CLUSTER) -> DataFrame:
    """The n most frequent values of each cluster as rows (label, rank, value, count).

    Spark keeps the first n ranks per task before it shuffles for the window.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(label, column)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    order = Window.partitionBy(label).orderBy(F.desc("count"), column)
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select(label, "rank", F.col(column).alias("value"), "count")
    )


def ranked_cells(top: DataFrame, name: str, label: str = CLUSTER) -> DataFrame:
    """Top rows as one cell per cluster: an array of (value, count) in rank order."""
    cell = F.array_sort(F.collect_list(F.struct("rank", "value", "count")))
    return top.groupBy(label).agg(
        F.transform(cell, lambda c: F.struct(c["value"].alias("value"), c["count"].alias("count"))).alias(name)
    )


def full_profile(df: DataFrame, label: str = CLUSTER) -> DataFrame:
    """Rounded means, size, and the top categories and countries of each cluster."""
    out = rounded_profile(df, label=label)
    for column, name in (("page1_mode", "top_categories"), ("country_mode", "top_countries")):
        out = out.join(ranked_cells(top_per_cluster(df, column, label=label), name, label), label, "left")
    return out


def mean_median(df: DataFrame, columns: Sequence[str] | None = None, label: str = CLUSTER) -> DataFrame:
    """Columns <c>_mean and <c>_median per cluster; medians are exact."""
    require_columns(df, [label])
    columns = numeric_columns(df) if columns is None else list(columns)
    means = df.groupBy(label).agg(*[F.avg(c).alias(f"{c}_mean") for c in columns])
    medians = (
        exact_quantiles(df, [label], columns, [0.5])
        .groupBy(label)
        .agg(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(f"{c}_median") for c in columns])
    )
    # a cluster without any value keeps its means row
    names = [n for c in columns for n in (f"{c}_mean", f"{c}_median")]
    return means.join(medians, label, "left").select(label, *names)


def cluster_means(df: DataFrame, columns: Sequence[str] | None = None, label: str = CLUSTER) -> DataFrame:
    columns = numeric_columns(df) if columns is None else list(columns)
    return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])


def melt(df: DataFrame, columns: Sequence[str], label: str = CLUSTER) -> DataFrame:
    """Rows (cluster, Feature, Value)."""
    return as_long(df, [label], columns, "Feature", "Value")


def crosstab(df: DataFrame, column: str, values: Sequence, label: str = CLUSTER) -> DataFrame:
    """Counts per cluster with a column for each of the named values, zero where there is none.

    ``category_counts`` has the counts of all values, however many there are.
    """
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(label).agg(*[F.count_if(F.col(column) == F.lit(v)).alias(str(v)) for v in values])


def category_counts(df: DataFrame, column: str, label: str = CLUSTER) -> DataFrame:
    """The cross-tab as rows (cluster, value, count), for any number of values."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(label, column)
        .agg(F.count(F.lit(1)).alias("count"))
    )


# The sentences of the insight report.
HEADLINE = "📊 **Automated Cluster Insight Summary**\n"
TOTAL = "\nTotal clusters detected: %d\n"
CLUSTER_HEAD = "\n---\n🟩 **Cluster %s Summary:**\n"
SESSION_VALUE = "- Average session value: %.2f"
BOUNCE_LIMIT = 0.4
SENTENCES = {
    "clicks": (
        "- Users in this cluster perform **many interactions** (high clicks).",
        "- Users in this cluster are **quick visitors** (low clicks).",
    ),
    "pages_nunique": (
        "- They explore **more unique pages** than average.",
        "- They view **fewer pages**, possibly focused shoppers.",
    ),
    "avg_price_per_click": (
        "- Their **average price per interaction** is high — potential buyers.",
        "- Their **price per interaction** is low — likely window shoppers.",
    ),
    "bounce": (
        "- They show **higher bounce rates**, leaving early.",
        "- They show **lower bounce rates**, indicating deeper engagement.",
    ),
}


def insights(means: DataFrame, label: str = CLUSTER) -> DataFrame:
    """Text per cluster from its means: rows (cluster, clusters, text).

    A feature is high when it is above the mean of the cluster means, the
    bounce rate when it is above a fixed limit. Rules of absent columns are
    left out.
    """
    known = [c for c in SENTENCES if c in means.columns]
    overall = means.agg(
        F.count(F.lit(1)).alias("clusters"), *[F.avg(c).alias(f"_all_{c}") for c in known]
    )
    one = F.lit(1)
    both = means.withColumn("_one", one).join(F.broadcast(overall.withColumn("_one", one)), "_one")
    lines = [F.format_string(CLUSTER_HEAD, F.col(label).cast("string"))]
    for c in known:
        limit = F.lit(BOUNCE_LIMIT) if c == "bounce" else F.col(f"_all_{c}")
        high, low = SENTENCES[c]
        lines.append(F.when(F.col(c) > limit, high).otherwise(low))
    value = F.col("sum_price") if "sum_price" in means.columns else F.lit(0.0)
    lines.append(F.format_string(SESSION_VALUE, value))
    return both.select(label, "clusters", F.concat_ws("\n", *lines).alias("text"))


def report_lines(texts: DataFrame, label: str = CLUSTER) -> DataFrame:
    """The whole report as lines (part, pos, line): the head is part NULL."""
    head = texts.select(
        F.lit(None).cast("bigint").alias("part"),
        F.concat(F.lit(HEADLINE + "\n"), F.format_string(TOTAL, "clusters")).alias("text"),
    ).limit(1)
    parts = head.unionByName(texts.select(F.col(label).cast("bigint").alias("part"), "text"))
    return parts.select("part", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def in_clusters(df: DataFrame, chosen: Sequence[int], label: str = CLUSTER) -> DataFrame:
    return df.where(F.col(label).isin(*chosen))


def known_clusters(df: DataFrame, label: str = CLUSTER) -> DataFrame:
    return df.select(label).distinct().orderBy(label)


def find_session(df: DataFrame, text: str, key: str = KEY) -> tuple[str, DataFrame]:
    """("found" | "not found" | "invalid", rows) for an id typed as text."""
    wanted = parsed_id(F.lit(text))
    if df.sparkSession.range(1).select(wanted.alias("id")).first()["id"] is None:
        return "invalid", df.limit(0)
    rows = df.where(F.col(key) == wanted)
    return ("not found" if rows.isEmpty() else "found"), rows


def as_fields(row: DataFrame, key: str = KEY) -> DataFrame:
    """One row turned to (key, field, value) rows, values as text."""
    return as_long(row, [key], [c for c in row.columns if c != key], "field", "value", "string")


def against_cluster(
    df: DataFrame, session: DataFrame, columns: Sequence[str] | None = None, label: str = CLUSTER
) -> DataFrame:
    """A session's numbers beside the averages of its cluster: (key, cluster, feature, value, cluster_mean)."""
    columns = numeric_columns(df) if columns is None else list(columns)
    mine = as_long(session, [KEY, label], columns, "feature", "value")
    # the session is one row, so its cluster filters the scan before the averages
    same = df.join(F.broadcast(session.select(label).limit(1)), label, "left_semi")
    means = as_long(cluster_means(same, columns, label), [label], columns, "feature", "cluster_mean")
    return mine.join(means, [label, "feature"]).select(KEY, label, "feature", "value", "cluster_mean")
