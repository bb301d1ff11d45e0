"""Click, session and labelled-session tables made from an event stream table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.cleaning import keep_plausible
from clickloom.operators.rollup import rollup_sessions


def numbered(df: DataFrame, group: str, ts: str, tie: str, name: str) -> DataFrame:
    """Number the rows of each group by (ts, tie), from 1.

    Rows are numbered inside time slices of a group and moved up by the row
    count of the earlier slices, so one huge group is spread over many tasks.
    """
    sliced = df.withColumn("_slice", F.date_trunc("minute", F.col(ts)))
    earlier = Window.partitionBy(group, "_day").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier_days = Window.partitionBy(group).orderBy("_day").rowsBetween(
        Window.unboundedPreceding, -1
    )
    per_slice = (
        sliced.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_day", F.date_trunc("day", "_slice"))
    )
    per_day = (
        sliced.groupBy(group, F.date_trunc("day", F.col("_slice")).alias("_day"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(group, "_day", F.coalesce(F.sum("_n").over(earlier_days), F.lit(0)).alias("_d0"))
    )
    starts = (
        per_slice.withColumn("_s0", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(per_day, [group, "_day"])
        .select(group, "_slice", (F.col("_s0") + F.col("_d0")).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(ts, tie))
    return (
        sliced.withColumn("_in", inside)
        .join(starts, [group, "_slice"])
        .withColumn(name, (F.col("_in") + F.col("_start")).cast("int"))
        .drop("_in", "_start", "_slice")
    )


def clicks_from_events(events: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    keyed = events.select(
        "event_id", "ts", "user_id", "event_type", "value", k.alias("k"),
        (F.col("user_id") * 1000 + F.dayofyear("ts")).cast("bigint").alias("session_id"),
    )
    return numbered(keyed, "session_id", "ts", "event_id", "order").select(
        "session_id",
        "order",
        ((F.col("user_id") * 7 + F.col("k")) % 25).cast("int").alias("country"),
        F.col("event_type").alias("page1_main_category"),
        F.concat(F.lit("M"), (F.col("k") % 40).cast("string")).alias("page2_clothing_model"),
        (F.col("value") * 2).alias("price"),
        F.when(F.col("value") > 35, 1).otherwise(2).alias("price_2"),
        (F.col("k") % 5 + 1).cast("int").alias("page"),
        "event_id",
    )


def with_gaps(clicks: DataFrame) -> DataFrame:
    """The click table with missing countries, categories, prices and pages."""
    gaps = {"country": 13, "page1_main_category": 11, "price": 17, "page": 19}
    return clicks.withColumns(
        {c: F.when(F.col("event_id") % n != 0, F.col(c)) for c, n in gaps.items()}
    )


def sessions_from_clicks(clicks: DataFrame) -> DataFrame:
    sessions = rollup_sessions(keep_plausible(clicks))
    return sessions.withColumns(
        {c: F.round(c, 6) for c in ("mean_price", "avg_price_per_click")}
    )


def labelled(sessions: DataFrame) -> DataFrame:
    """Sessions with a rule-based cluster and a fixed train/test split."""
    rule = F.when(F.col("bounce") == 1, 0).when(F.col("sum_price") >= 300, 2).otherwise(1)
    split = F.when(F.col("session_id") % 5 == 0, "test").otherwise("train")
    return sessions.withColumns({"cluster": rule, "split": split})
