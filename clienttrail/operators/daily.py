"""Daily partial aggregates of events, written once, and the reports that merge them for a range of days.

Counts, first and last dates and sums of a day add up with those of other days, distinct clients do not: so a
partial has one row for each day, event type and client. Plans and regions have a partial of their own, one row
for each day, type and pair of them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clienttrail.operators import checks, funnel


def _day() -> Column:
    return F.col("event_date").cast("date").alias("event_day")


def daily_numbers(events: DataFrame) -> DataFrame:
    """Per day, event type and client: events, first and last date, sum and number of sales reps.

    Null days, types and clients are values of their own. Rows shrink before their only shuffle.
    """
    return events.groupBy(_day(), "event_type", "client_id").agg(*checks.client_numbers())


def daily_values(events: DataFrame) -> DataFrame:
    """The different plans and regions of each day and event type."""
    return events.select(_day(), "event_type", "plan", "region").distinct()


def between_days(parts: DataFrame, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
    """The partials of a range of days, both ends included; parts written by day are pruned to these folders.

    Without an end the range is open there. A null day is in no range that has an end.
    """
    if first_day is not None:
        parts = parts.where(F.col("event_day") >= F.lit(first_day))
    if last_day is not None:
        parts = parts.where(F.col("event_day") <= F.lit(last_day))
    return parts


def merged_distribution(numbers: DataFrame, values: DataFrame) -> DataFrame:
    """checks.event_distribution() of the events that the partials were made of."""
    by_client = numbers.groupBy("event_type", "client_id").agg(
        F.sum("n").alias("n"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("rep_sum").alias("rep_sum"),
        F.sum("rep_n").alias("rep_n"),
    )
    return checks.with_value_lists(checks.numbers_of_types(by_client), values)


def merged_funnel(numbers: DataFrame) -> DataFrame:
    """funnel.client_funnel() of the events that the partials were made of: first dates of first dates."""
    firsts = numbers.select("client_id", "event_type", F.col("first").alias("event_date"))
    return funnel.client_funnel(firsts)
