"""Counts of values, most frequent values and row numbering at scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import as_long
from clickloom.sources.staging import stage


def value_counts(df: DataFrame, by: str, name: str = "count") -> DataFrame:
    """Rows per value, missing values left out, in value order."""
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(by)
    )


def top_values(df: DataFrame, by: str, n: int = 10, name: str = "count") -> DataFrame:
    """The n most frequent values, ties in value order."""
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), by)
        .limit(n)
    )


def shares(df: DataFrame, by: str, name: str = "share") -> DataFrame:
    """Each value's part of the rows that have a value."""
    present = df.where(F.col(by).isNotNull())
    counts = present.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    total = present.agg(F.count(F.lit(1)).alias("_total"))
    # a one-row table joined on a constant key: the total reaches every value
    return (
        counts.withColumn("_one", F.lit(1))
        .join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
        .select(by, (F.col("_n") / F.col("_total")).alias(name))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of each column, the smallest one on a tie.

    Counting runs by (column, value), so no column's values meet in one group
    before they are reduced. Values are compared in their own type.
    """
    types = dict(df.dtypes)
    long = as_long(df, [], columns, "column", "value", "string")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("_n")
    )
    numeric = [c for c in columns if types[c] != "string"]
    as_number = F.when(F.col("column").isin(numeric), F.col("value").cast("double"))
    best = counts.groupBy("column").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), as_number.alias("num"), "value")).alias("_best")
    )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(best, "column", "left").select("column", F.col("_best.value").alias("value"))


def ranked(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number all rows from 0 in the given order without a one-task sort.

    Rows are range-partitioned and sorted, written with their part number, and
    moved up by the row count of the earlier parts.
    """
    parts = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()),
        "ranked",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        parts.withColumn("_in", inside)
        .join(starts, "_part")
        .withColumn(name, (F.col("_in") + F.col("_start")).cast("bigint"))
        .drop("_in", "_start", "_part")
    )
