"""Exploratory tables: shapes, counts, descriptions, histograms, densities."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import as_long
from clickloom.functions.quantiles import exact_quantiles
from clickloom.functions.ranking import value_counts
from clickloom.schema import KEY
from clickloom.sources.staging import stage

GRID_POINTS = 200


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count and the column names."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(", ".join(df.columns)).alias("columns"),
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_page_counts(clicks: DataFrame) -> DataFrame:
    """How many sessions end on each page."""
    step = F.struct("order", "page")
    placed = F.col("page").isNotNull() & F.col("order").isNotNull()
    last = (
        clicks.where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.max(F.when(placed, step))["page"].alias("last_page"))
    )
    return value_counts(last, "last_page", "sessions")


def price_by_page(clicks: DataFrame) -> DataFrame:
    return (
        clicks.where(F.col("page").isNotNull())
        .groupBy("page")
        .agg(F.avg("price").alias("mean_price"))
        .orderBy("page")
    )


def session_lengths(clicks: DataFrame) -> DataFrame:
    return clicks.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("order").alias("clicks"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row."""
    quartiles = exact_quantiles(df, [], [column], [0.25, 0.5, 0.75])
    spots = quartiles.groupBy("feature").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
            for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ]
    )
    c = F.col(column)
    basics = df.agg(
        F.lit(column).alias("feature"),
        F.count(c).alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
    )
    return basics.join(spots, "feature").select(
        "feature", "n", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson coefficients of all column pairs as rows (x, y, r), from one pass.

    A pair uses the rows where both columns hold a value; a constant column
    gives NULL.
    """
    cells = []
    for x, y in combinations_with_replacement(columns, 2):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        u = F.when(both, F.col(x).cast("double"))
        v = F.when(both, F.col(y).cast("double"))
        r = F.try_divide(F.covar_pop(u, v), F.stddev_pop(u) * F.stddev_pop(v))
        for a, b in {(x, y), (y, x)}:
            cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r.alias("r")))
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins (bin, lower, upper, count), empty ones included.

    The last bin is closed on both sides; a constant column gets a range of
    one around its value.
    """
    value = F.col(column).cast("double")
    flat = F.col("least") == F.col("most")
    edges = df.agg(F.min(value).alias("least"), F.max(value).alias("most")).select(
        F.when(flat, F.col("least") - 0.5).otherwise(F.col("least")).alias("low"),
        F.when(flat, F.col("most") + 0.5).otherwise(F.col("most")).alias("high"),
    )
    # the range is one row; reading it turns binning into a plain projection
    low, high = edges.first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, count bigint")
    width = (high - low) / bins
    spot = F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1)) + 1
    counts = df.where(value.isNotNull()).groupBy(spot.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def density(
    df: DataFrame, column: str, by: Sequence[str] = (), cut: float = 3.0, points: int = GRID_POINTS
) -> DataFrame:
    """Gaussian kernel density on an even grid, per group.

    The bandwidth is Scott's: sample deviation times n^(-1/5). The grid runs
    ``cut`` bandwidths past the extremes. Equal values are counted first, each
    distinct value then adds to the fixed number of grid points of its group;
    groups without any spread have no curve.
    """
    by = list(by)
    value = F.col(column).cast("double")
    present = df.where(value.isNotNull()).select(*by, value.alias("_v"))
    n = F.count(F.lit(1))
    grids = (
        present.groupBy(*by).agg(
            n.alias("_n"),
            F.min("_v").alias("_least"),
            F.max("_v").alias("_most"),
            F.stddev_samp("_v").alias("_std"),
        )
        .where(F.col("_std") > 0)
        .withColumn("_h", F.col("_std") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
        .withColumn("_low", F.col("_least") - F.col("_h") * cut)
        .withColumn("_step", (F.col("_most") + F.col("_h") * cut - F.col("_low")) / (points - 1))
    )
    grids = stage(grids, "grids")
    weighted = present.groupBy(*by, "_v").agg(n.alias("_w"))
    on = by or ["_one"]
    if not by:
        grids, weighted = grids.withColumn("_one", F.lit(1)), weighted.withColumn("_one", F.lit(1))
    spots = F.explode(F.sequence(F.lit(1), F.lit(points)))
    x = F.col("_low") + (F.col("point") - 1) * F.col("_step")
    z = (F.col("x") - F.col("_v")) / F.col("_h")
    return (
        weighted.join(grids, on)
        .select(*by, "_n", "_h", "_v", "_w", "_low", "_step", spots.alias("point"))
        .withColumn("x", x)
        .groupBy(*by, "point", "x", "_n", "_h")
        .agg(F.sum(F.col("_w") * F.exp(z * z * -0.5)).alias("_sum"))
        .select(
            *by, "point", "x",
            (F.col("_sum") / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))).alias("density"),
        )
    )


def box_stats(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges and outlier counts."""
    quartiles = exact_quantiles(df, [by], columns, [0.25, 0.5, 0.75])
    boxes = quartiles.groupBy(by, "feature").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
            for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
        ]
    )
    boxes = stage(boxes, "boxes")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("_v") >= F.col("q1") - reach) & (F.col("_v") <= F.col("q3") + reach)
    return (
        as_long(df, [by], columns, "feature", "_v")
        .where(F.col("_v").isNotNull())
        .join(boxes, [by, "feature"])
        .groupBy(by, "feature", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )

