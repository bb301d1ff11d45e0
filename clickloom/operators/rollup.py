"""Clicks to one row per session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import ratio
from clickloom.schema import KEY

# The attributes a session is described by; each is counted per value first.
_ATTRIBUTES = ["page", "page2_clothing_model", "country", "page1_main_category"]


def rollup_sessions(clicks: DataFrame, price_digits: int | None = 2) -> DataFrame:
    """One row per session: counts, price figures, last page and modes.

    Grouping sets count every attribute value of a session in one scan; the
    second aggregation reduces those counts with fixed-size buffers. Neither
    step gathers a session's clicks or value sets, so one session may hold a
    large part of the table. Prices with ``price_digits`` decimals are summed
    as whole numbers, which makes sums independent of the partitioning; None
    sums them as doubles.
    """
    scale = 1 if price_digits is None else 10**price_digits
    price = F.col("price")
    amount = price if price_digits is None else F.round(price * scale).cast("bigint")
    per_value = (
        clicks.where(F.col(KEY).isNotNull())
        .groupingSets([[F.col(KEY), F.col(a)] for a in _ATTRIBUTES], KEY, *_ATTRIBUTES)
        .agg(
            F.grouping_id().alias("_set"),
            F.count("order").alias("_clicks"),
            F.count(F.lit(1)).alias("_rows"),
            F.sum(amount).alias("_sum"),
            F.count("price").alias("_priced"),
            F.max("price").alias("_max"),
            F.max("order").alias("_last"),
        )
    )
    # grouping_id has a bit set for every attribute left out of the row's set
    every_bit = (1 << len(_ATTRIBUTES)) - 1
    code = {a: every_bit ^ (1 << (len(_ATTRIBUTES) - 1 - i)) for i, a in enumerate(_ATTRIBUTES)}

    def in_set(attribute, value):
        return F.when(F.col("_set") == code[attribute], value)

    def mode(attribute):
        seen = F.col(attribute).isNotNull()
        best = F.struct((-F.col("_rows")).alias("n"), F.col(attribute).alias("value"))
        return F.min(in_set(attribute, F.when(seen, best)))["value"]

    latest = F.struct(F.col("_last"), F.col("page"))
    placed = F.col("page").isNotNull() & F.col("_last").isNotNull()
    total = F.sum(in_set("page", F.col("_sum"))) / F.lit(float(scale))
    rolled = per_value.groupBy(KEY).agg(
        F.sum(in_set("page", F.col("_clicks"))).alias("clicks"),
        F.coalesce(total, F.lit(0.0)).alias("sum_price"),
        ratio(total, F.sum(in_set("page", F.col("_priced")))).alias("mean_price"),
        F.max(in_set("page", F.col("_max"))).alias("max_price"),
        F.count(in_set("page", F.col("page"))).alias("pages_nunique"),
        F.max(in_set("page", F.when(placed, latest)))["page"].alias("last_page"),
        F.count(in_set("page2_clothing_model", F.col("page2_clothing_model"))).alias("distinct_models"),
        mode("country").alias("country_mode"),
        mode("page1_main_category").alias("page1_mode"),
    )
    return rolled.withColumns(
        {
            "avg_price_per_click": ratio(F.col("sum_price"), F.col("clicks")),
            "bounce": (F.col("clicks") == 1).cast("int"),
        }
    )
