"""Threshold tests. All are inclusive, and a NULL threshold never alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_number(trigger_value: Column) -> Column:
    """A threshold as a count; text that is not a number becomes NULL."""
    return trigger_value.try_cast("bigint")


def at_least(counts: DataFrame, trigger_value: int | Column) -> DataFrame:
    """Keep the counts that reach the threshold.

    A group has at least one request by nature; the extra test removes the
    empty groups that clock rows leave behind in a stream.
    """
    limit = trigger_value if isinstance(trigger_value, Column) else F.lit(trigger_value)
    return counts.where((F.col("times") >= limit) & (F.col("times") >= 1))
