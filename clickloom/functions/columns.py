"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as a double, NULL for a zero or missing divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """top / bottom where the divisor is above zero, otherwise 0."""
    return F.when(bottom > 0, top.cast("double") / bottom.cast("double")).otherwise(F.lit(0.0))


def half_even(value: Column, digits: int = 2) -> Column:
    return F.bround(value, digits)


def percent_gap(base: Column, other: Column) -> Column:
    """Difference of two values in percent of the first, guarded against zero."""
    return F.abs(base - other) / (F.abs(base) + F.lit(1e-9)) * 100


def parsed_id(text: Column) -> Column:
    """Text as a key, NULL when it is not a whole number."""
    return F.trim(text).try_cast("bigint")


def squared_distance(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [(x - y) * (x - y) for x, y in zip(left, right)])


def complete(name: str) -> Column:
    """The column as a double; a missing value stops the job."""
    missing = F.raise_error(F.lit(f"feature {name} is missing")).cast("double")
    return F.coalesce(F.col(name).cast("double"), missing).alias(name)


def as_long(df, keep: Sequence[str], columns: Sequence[str], name: str, value: str, dtype="double"):
    """Melt ``columns`` to (name, value) rows within the scan stage."""
    cells = [F.struct(F.lit(c).alias(name), F.col(c).cast(dtype).alias(value)) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))
