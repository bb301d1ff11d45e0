import pytest
from pyspark.sql import functions as F

from clickloom.operators.cleaning import count_removed, keep_plausible
from clickloom.operators.rollup import rollup_sessions
from clickloom.schema import CLICKS

ROWS = [
    # session, order, country, category, model, price, price_2, page
    (1, 1, 7, "b", "M1", 10.0, 1, 1), (1, 2, 3, "a", "M2", 20.5, 1, 2),  # mode ties
    (2, 1, None, "b", "M1", 5.0, 1, 2), (2, 2, None, "a", None, 5.0, 1, None), (2, 3, None, None, "M1", None, 1, None),
    (3, 1, 4, None, None, None, 1, None), (3, 2, 4, None, None, None, 1, None),  # nothing priced
    (4, None, 4, "a", "M1", 1.0, 1, 3), (4, None, 4, "a", "M1", 1.0, 1, 4),  # no order
    (None, 1, 1, "a", "M1", 9.0, 1, 1),
    (5, 1, 2, "c", "M3", 7.25, 1, 5),  # a bounce
    (6, 2, 9, "a", "M1", 1.0, 1, 4), (6, 2, 9, "a", "M1", 1.0, 1, 5), (6, 1, 9, "a", "M1", 1.0, 1, 3),  # equal orders
]


def sessions(spark, rows=ROWS, parts=1):
    clicks = spark.createDataFrame(rows, CLICKS).repartition(parts)
    return {r["session_id"]: r for r in rollup_sessions(clicks).collect()}


def test_ties_take_the_smallest_value(spark):
    row = sessions(spark)[1]
    assert (row["country_mode"], row["page1_mode"]) == (3, "a")
    assert (row["clicks"], row["sum_price"], row["mean_price"], row["max_price"]) == (2, 30.5, 15.25, 20.5)
    assert (row["pages_nunique"], row["last_page"], row["distinct_models"], row["bounce"]) == (2, 2, 2, 0)


def test_missing_values_are_skipped(spark):
    row = sessions(spark)[2]
    assert (row["country_mode"], row["page1_mode"], row["last_page"], row["distinct_models"]) == (None, "a", 2, 1)
    assert row["clicks"] == 3 and row["mean_price"] == 5.0
    assert row["avg_price_per_click"] == pytest.approx(10 / 3)


def test_all_missing_group(spark):
    row = sessions(spark)[3]
    assert (row["sum_price"], row["mean_price"], row["max_price"]) == (0.0, None, None)
    assert row["page1_mode"] is None and row["pages_nunique"] == 0


def test_no_order_gives_no_clicks(spark):
    row = sessions(spark)[4]
    assert (row["clicks"], row["avg_price_per_click"], row["last_page"], row["bounce"]) == (0, None, None, 0)


def test_null_key_is_dropped_and_single_click_bounces(spark):
    rows = sessions(spark)
    assert None not in rows and len(rows) == 6
    assert rows[5]["bounce"] == 1


def test_equal_orders_break_by_page(spark):
    assert sessions(spark)[6]["last_page"] == 5


def test_partitioning_does_not_matter(spark):
    first = sessions(spark)
    for parts in (4, 7):
        assert sessions(spark, ROWS[::-1], parts) == first


def test_one_session_may_hold_most_rows(spark):
    hot = spark.range(60_000).select(
        F.lit(1).cast("bigint").alias("session_id"),
        F.col("id").cast("int").alias("order"),
        (F.col("id") % 47).cast("int").alias("country"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("page1_main_category"),
        F.concat(F.lit("M"), F.col("id") % 20_000).alias("page2_clothing_model"),
        F.lit(0.01).alias("price"), F.lit(1).alias("price_2"),
        (F.col("id") % 5).cast("int").alias("page"),
    )
    cold = spark.createDataFrame(ROWS[-3:], CLICKS)
    out = rollup_sessions(hot.unionByName(cold))
    row = out.where("session_id = 1").first()
    assert (row["clicks"], row["sum_price"], row["distinct_models"]) == (60_000, 600.0, 20_000)
    assert (row["last_page"], row["country_mode"], row["page1_mode"]) == (59_999 % 5, 0, "c0")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in plan and "ObjectHashAggregate" not in plan and "Window" not in plan


def test_outlier_bounds(spark):
    rows = [(1, o, 1, "a", "M", p, 1, 1) for o, p in ((1, 0.0), (1, 500.0), (1, None), (101, 5.0), (100, 5.0), (None, 5.0), (1, float("nan")))]
    clicks = spark.createDataFrame(rows, CLICKS)
    assert keep_plausible(clicks).count() == 1
    assert tuple(count_removed(clicks).first()) == (7, 1, 6)
