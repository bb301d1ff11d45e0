"""Scaling, drift, suffix join, derived features and frequency encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import percent_gap, ratio_or_zero
from clickloom.functions.ranking import shares
from clickloom.schema import ENGINEERED_FEATURES, KEY, SESSION_CATEGORIES, SESSION_FEATURES
from clickloom.sources.staging import stage


def fit_scaler(df: DataFrame, columns: Sequence[str] = SESSION_FEATURES) -> DataFrame:
    """Rows (column, mean, std) with the population deviation, from one pass."""
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def apply_scaler(
    df: DataFrame, params: DataFrame, keep: Sequence[str] = (KEY,), in_place: bool = False
) -> DataFrame:
    """(x - mean) / std per fitted column; a constant column is only moved, its scale counts as 1.

    ``params`` has one row per feature, so it is read here and the scaling is
    a plain projection. ``in_place`` keeps all other columns of the table.
    """
    scaled = {}
    for row in params.collect():
        if row["mean"] is None:
            continue
        shifted = F.col(row["column"]).cast("double") - F.lit(row["mean"])
        scaled[row["column"]] = shifted / F.lit(row["std"] or 1.0)
    if in_place:
        return df.withColumns(scaled)
    return df.select(*keep, *[c.alias(name) for name, c in scaled.items()])


def compare_distributions(
    train: DataFrame, test: DataFrame, columns: Sequence[str] = SESSION_FEATURES
) -> DataFrame:
    """Means, sample deviations and the difference of means in percent."""

    def moments(df: DataFrame, side: str) -> DataFrame:
        cells = [
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(c).alias(f"{side}_mean"),
                F.stddev_samp(c).alias(f"{side}_std"),
            )
            for c in columns
        ]
        return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))

    return (
        moments(train, "train")
        .join(moments(test, "test"), "feature")
        .select(
            "feature", "train_mean", "test_mean", "train_std", "test_std",
            percent_gap(F.col("train_mean"), F.col("test_mean")).alias("%diff"),
        )
    )


def suffix_join(left: DataFrame, right: DataFrame, on: str = KEY, suffix: str = "_scaled") -> DataFrame:
    """Inner join on the key; columns both sides have get the suffix on the left."""
    both = set(left.columns) & set(right.columns) - {on}
    renamed = left.withColumnsRenamed({c: f"{c}{suffix}" for c in both})
    return renamed.join(right, on, "inner")


def add_derived(df: DataFrame) -> DataFrame:
    """Ratios and spreads of a session that are not in the rollup."""
    return df.withColumns(
        {
            "exploration_ratio": ratio_or_zero(F.col("distinct_models"), F.col("clicks")),
            "value_per_model": ratio_or_zero(F.col("sum_price"), F.col("distinct_models")),
            "price_variability": F.col("max_price") - F.col("mean_price"),
            "page_depth": F.col("last_page"),
        }
    )


def fit_frequencies(train: DataFrame, column: str) -> DataFrame:
    """Share of each value in the train rows, staged so that its size is known."""
    return stage(shares(train, column, f"{column}_freq_enc"), "frequencies")


def apply_frequencies(df: DataFrame, fitted: DataFrame, column: str, unseen: float | None = None) -> DataFrame:
    """Encode by the fitted shares; ``unseen`` fills missing and new values."""
    out = f"{column}_freq_enc"
    coded = df.join(fitted, column, "left")
    return coded if unseen is None else coded.withColumn(out, F.coalesce(out, F.lit(unseen)))


def frequency_encode(train: DataFrame, test: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    fitted = fit_frequencies(train, column)
    return apply_frequencies(train, fitted, column), apply_frequencies(test, fitted, column, 0.0)


def engineer(
    train: DataFrame,
    test: DataFrame,
    train_scaled: DataFrame | None = None,
    test_scaled: DataFrame | None = None,
    scaled: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The engineered tables of both splits: fourteen features and the key.

    The features come from the unscaled session columns, as the names without
    a suffix do after the join with the scaled table. That join only keeps the
    sessions found in both, so it is a semi join here. ``scaled=True`` takes
    the scaled columns instead where there are any.
    """
    sides = []
    for sessions, extra in ((train, train_scaled), (test, test_scaled)):
        if extra is None:
            sides.append(sessions)
        elif scaled:
            sides.append(suffix_join(extra, sessions))
        else:
            sides.append(sessions.join(extra.select(KEY), KEY, "left_semi"))
    left, right = (add_derived(s) for s in sides)
    for column in SESSION_CATEGORIES:
        left, right = frequency_encode(left, right, column)

    def final(df: DataFrame) -> DataFrame:
        names = {c: f"{c}_scaled" if scaled and f"{c}_scaled" in df.columns else c for c in ENGINEERED_FEATURES}
        return df.select(*[F.col(src).alias(c) for c, src in names.items()], KEY)

    return final(left), final(right)


def mean_clicks(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("sessions"), F.avg("clicks").alias("mean_clicks")
    )
