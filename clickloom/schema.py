"""Column lists, table schemas and the checks made against them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = "session_id"
CLUSTER = "cluster"

CLICKS = T.StructType(
    [
        T.StructField("session_id", T.LongType()),
        T.StructField("order", T.IntegerType()),
        T.StructField("country", T.IntegerType()),
        T.StructField("page1_main_category", T.StringType()),
        T.StructField("page2_clothing_model", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("price_2", T.IntegerType()),
        T.StructField("page", T.IntegerType()),
    ]
)

# The feature lists the session models are built on.
SESSION_FEATURES = [
    "clicks", "sum_price", "mean_price", "max_price", "pages_nunique",
    "distinct_models", "avg_price_per_click", "last_page", "bounce",
]
PROFILE_FEATURES = [
    "clicks", "sum_price", "mean_price", "max_price", "pages_nunique",
    "distinct_models", "avg_price_per_click", "bounce",
]
ENGINEERED_FEATURES = [
    "clicks", "sum_price", "mean_price", "max_price", "pages_nunique",
    "distinct_models", "avg_price_per_click", "bounce",
    "exploration_ratio", "value_per_model", "price_variability",
    "page_depth", "country_mode_freq_enc", "page1_mode_freq_enc",
]
SESSION_CATEGORIES = ["country_mode", "page1_mode"]
CORRELATED = ["order", "price", "price_2", "page"]


class MissingColumns(ValueError):
    """A table lacks columns an operator needs."""


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise MissingColumns(f"table lacks the columns {absent}; it has {df.columns}")
    return df


def numeric_columns(df: DataFrame, without: Sequence[str] = (KEY, CLUSTER)) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in without
    ]


def categorical_columns(df: DataFrame, without: Sequence[str] = (KEY, CLUSTER)) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if not isinstance(f.dataType, T.NumericType) and f.name not in without
    ]
