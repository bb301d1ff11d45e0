"""Outlier filters, the missing-value report and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import as_long
from clickloom.functions.quantiles import exact_quantiles
from clickloom.functions.ranking import modes
from clickloom.schema import categorical_columns, numeric_columns


def plausible(low: float = 0, high: float = 500, max_order: int = 100) -> Column:
    price, order = F.col("price"), F.col("order")
    return (price > low) & (price < high) & (order <= max_order)


def keep_plausible(clicks: DataFrame, **bounds) -> DataFrame:
    """Clicks with a price inside the bounds and an order up to the cap."""
    return clicks.where(plausible(**bounds))


def count_removed(clicks: DataFrame, **bounds) -> DataFrame:
    """How many clicks ``keep_plausible`` drops, in one pass without a shuffle of rows."""
    kept = F.count_if(plausible(**bounds))
    return clicks.agg(
        F.count(F.lit(1)).alias("before"),
        kept.alias("after"),
        (F.count(F.lit(1)) - kept).alias("removed"),
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Missing values per column that has any, most first."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (
        as_long(counts, [], df.columns, "column_name", "n_missing", "bigint")
        .where(F.col("n_missing") > 0)
        .orderBy(F.desc("n_missing"), "column_name")
    )


def fit_imputer(
    df: DataFrame,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    default: str = "unknown",
) -> DataFrame:
    """Fill values: median of numeric columns, smallest mode of the others."""
    numeric = numeric_columns(df) if numeric is None else list(numeric)
    categorical = categorical_columns(df) if categorical is None else list(categorical)
    parts = []
    if numeric:
        parts.append(
            exact_quantiles(df, [], numeric, [0.5]).select(
                F.col("feature").alias("column"),
                F.lit("num").alias("kind"),
                F.col("value").alias("num_value"),
                F.lit(None).cast("string").alias("str_value"),
            )
        )
    if categorical:
        parts.append(
            modes(df, categorical).select(
                F.col("column"),
                F.lit("cat").alias("kind"),
                F.lit(None).cast("double").alias("num_value"),
                F.coalesce("value", F.lit(default)).alias("str_value"),
            )
        )
    if not parts:
        raise ValueError("nothing to impute")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def apply_imputer(df: DataFrame, params: DataFrame) -> DataFrame:
    """Fill missing cells; columns the table lacks are skipped.

    ``params`` has one row per column of the table, so reading it here is
    bounded by the width of the table.
    """
    types = dict(df.dtypes)
    fills: dict[str, Column] = {}
    for row in params.collect():
        name = row["column"]
        value = row["num_value"] if row["kind"] == "num" else row["str_value"]
        if name not in types or name in fills or value is None:
            continue
        # the half-way median of whole numbers stays a double
        halfway = row["kind"] == "num" and not float(value).is_integer()
        fill = F.lit(value) if halfway else F.lit(value).cast(types[name])
        fills[name] = F.coalesce(F.col(f"`{name}`"), fill)
    return df.withColumns(fills) if fills else df
