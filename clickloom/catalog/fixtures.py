"""The tables the registered queries read, derived by Spark from ``events``.

Each is written once per application and scale folder, as the files between
the steps of a run would be, and read back from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.features import engineer
from clickloom.sources.event_clicks import (
    clicks_from_events,
    labelled,
    sessions_from_clicks,
    with_gaps,
)
from clickloom.sources.staging import stage
from clickloom.sources.tables import read_table

_tables: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf: str, name: str, make) -> DataFrame:
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _tables:
        # one file per core, so that small tables are scanned in parallel too
        lanes = spark.sparkContext.defaultParallelism
        _tables[at] = stage(make().repartition(lanes), name)
    return _tables[at]


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, f"{sf}/events.parquet")
    return _once(spark, sf, "clicks", lambda: clicks_from_events(events))


def clicks_missing(spark: SparkSession, sf: str) -> DataFrame:
    return with_gaps(clicks(spark, sf))


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled sessions with a train/test split."""
    return _once(spark, sf, "sessions", lambda: labelled(sessions_from_clicks(clicks(spark, sf))))


def train(spark: SparkSession, sf: str) -> DataFrame:
    return sessions(spark, sf).where(F.col("split") == "train")


def test(spark: SparkSession, sf: str) -> DataFrame:
    return sessions(spark, sf).where(F.col("split") == "test")


def engineered(spark: SparkSession, sf: str) -> DataFrame:
    return _once(spark, sf, "engineered", lambda: engineer(train(spark, sf), test(spark, sf))[0])


def click_split(spark: SparkSession, sf: str, split: str, gaps: bool = True) -> DataFrame:
    """Clicks, with or without gaps, divided by session like the sessions are."""
    is_test = F.col("session_id") % 5 == 0
    source = clicks_missing(spark, sf) if gaps else clicks(spark, sf)
    return source.where(is_test if split == "test" else ~is_test).drop("event_id")
