"""Churn: recency, churn flag, risk categories and the tables of the churn report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clienttrail.functions import (
    as_of_literal,
    date_text,
    elapsed_days,
    month_text,
    percent_text,
    ratio,
)
from clienttrail.operators.profile import client_profile
from clienttrail.operators.shape import to_rows
from clienttrail.schema import APPLIED, CHURNED, SIGNED

# Risk categories in report order and their limits in days.
HIGH_RISK = "High Risk"
MEDIUM_RISK = "Medium Risk"
LOW_RISK = "Low Risk"
ALREADY_CHURNED = "Already Churned"
UNKNOWN_RISK = "Unknown"
RISKS = (HIGH_RISK, MEDIUM_RISK, LOW_RISK, ALREADY_CHURNED, UNKNOWN_RISK)
LOW_RISK_DAYS = 30
MEDIUM_RISK_DAYS = 60
MISSING_DAYS_SORT_AS = 999


def churn_last_events(events: DataFrame) -> DataFrame:
    """Per client the last event date and the last applied, signed and churned dates."""
    return client_profile(events).select(
        "client_id",
        F.col("last_event").alias("last_event_date"),
        F.col("last_applied").alias("applied_date"),
        F.col("last_signed").alias("signed_date"),
        F.col("last_churned").alias("churned_date"),
    )


def churn_last_type(events: DataFrame, dedup: bool = False) -> DataFrame:
    """The last events with the type of the event on the last date.

    Only first occurrences (`event_rank` 1) count: the type is null if the last event repeats an
    earlier one, and a client has one row per type if several types first occur on the last date.
    With `dedup`, each client has one row with the type of its latest record.

    An event ranked 1 lies on the last date exactly if its type's first date is the last date, so
    neither a rank nor a join is needed: events shrink to one row per client and type, and a window
    over those few rows finds the last date.
    """
    if dedup:
        return _latest_type(events)
    by_type = events.groupBy("client_id", "event_type").agg(
        F.min("event_date").alias("first"), F.max("event_date").alias("last")
    )
    latest_first = Window.partitionBy("client_id").orderBy(F.desc("last"))
    client = latest_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def last_of(event_type: str) -> Column:
        return F.max(F.when(F.col("event_type") == event_type, F.col("last"))).over(client)

    per_type = by_type.select(
        "client_id",
        "event_type",
        "first",
        F.max("last").over(client).alias("last_event_date"),
        last_of(APPLIED).alias("applied_date"),
        last_of(SIGNED).alias("signed_date"),
        last_of(CHURNED).alias("churned_date"),
        F.max("first").over(client).alias("latest_first"),
        F.row_number().over(latest_first).alias("position"),
    )
    # A null client id equals no other, so it never gets a type.
    known = F.col("client_id").isNotNull()
    has_type = known & (F.col("first") == F.col("last_event_date"))
    client_has_type = known & (F.col("latest_first") == F.col("last_event_date"))
    return per_type.where(has_type | (~client_has_type & (F.col("position") == 1))).select(
        "client_id",
        "last_event_date",
        "applied_date",
        "signed_date",
        "churned_date",
        F.when(has_type, F.col("event_type")).alias("last_event_type"),
    )


def _latest(events: DataFrame, column: str) -> DataFrame:
    """Per client, value and date the latest record: a hash aggregation that shrinks the events."""
    return events.groupBy("client_id", column, "event_date").agg(F.max("record_id").alias("record_id"))


def _value_of_latest(column: str) -> Column:
    """The value on the latest record; among records of one date and id, the largest value."""
    return F.max_by(column, F.struct("event_date", "record_id", column))


def _latest_type(events: DataFrame) -> DataFrame:
    def last_of(event_type: str) -> Column:
        return F.max(F.when(F.col("event_type") == event_type, F.col("event_date")))

    return _latest(events, "event_type").groupBy("client_id").agg(
        F.max("event_date").alias("last_event_date"),
        last_of(APPLIED).alias("applied_date"),
        last_of(SIGNED).alias("signed_date"),
        last_of(CHURNED).alias("churned_date"),
        _value_of_latest("event_type").alias("last_event_type"),
    )


def client_churn(events: DataFrame, as_of: datetime | str, dedup: bool = False) -> DataFrame:
    """Last events per client with the churn flag and fractional days up to `as_of` (UTC)."""
    now = as_of_literal(as_of)
    return churn_last_type(events, dedup).select(
        "*",
        F.col("churned_date").isNotNull().cast("int").alias("is_churned"),
        elapsed_days("last_event_date", now).alias("days_since_last_event"),
        elapsed_days("signed_date", now).alias("days_since_signed"),
    )


def risk_category(days: Column, is_churned: Column | None = None) -> Column:
    """Risk from idle days and, if known, the churn flag."""
    by_days = (
        F.when(days.isNull(), UNKNOWN_RISK)
        .when(days <= LOW_RISK_DAYS, LOW_RISK)
        .when(days <= MEDIUM_RISK_DAYS, MEDIUM_RISK)
        .otherwise(HIGH_RISK)
    )
    if is_churned is None:
        return by_days
    return F.when(is_churned == 1, ALREADY_CHURNED).otherwise(by_days)


def client_risk(churn: DataFrame) -> DataFrame:
    """Add `risk_category`; without a churn flag only the idle days decide."""
    flag = F.col("is_churned") if "is_churned" in churn.columns else None
    return churn.withColumn("risk_category", risk_category(F.col("days_since_last_event"), flag))


def _is(risk: str) -> Column:
    return F.col("risk_category") == risk


def churn_summary(risk: DataFrame) -> DataFrame:
    """One row: clients per category and mean idle days.

    `avg_days_active` leaves out churned clients and is 0 if there are no others.
    """
    active_days = F.avg(F.when(~_is(ALREADY_CHURNED), F.col("days_since_last_event")))
    no_active = F.count_if(~_is(ALREADY_CHURNED)) == 0
    return risk.agg(
        F.count(F.lit(1)).alias("total_clients"),
        F.count_if(_is(ALREADY_CHURNED)).alias("churned_clients"),
        F.count_if(_is(HIGH_RISK) | _is(MEDIUM_RISK)).alias("at_risk_clients"),
        F.count_if(_is(HIGH_RISK)).alias("high_risk_clients"),
        F.count_if(_is(MEDIUM_RISK)).alias("medium_risk_clients"),
        F.count_if(_is(LOW_RISK)).alias("low_risk_clients"),
        F.count_if(_is(UNKNOWN_RISK)).alias("unknown_risk_clients"),
        F.count("signed_date").alias("clients_with_signed"),
        F.when(no_active, F.lit(0.0)).otherwise(active_days).alias("avg_days_active"),
        F.avg("days_since_last_event").alias("avg_days_since_last_event"),
        F.avg("days_since_signed").alias("avg_days_since_signed"),
    ).withColumn(
        "churned_percentage", ratio(F.col("churned_clients"), F.col("total_clients")) * 100
    )


def churn_summary_table(summary: DataFrame) -> DataFrame:
    """The summary as metric name and value text."""

    def text(count: str) -> Column:
        return F.col(count).cast("string")

    return to_rows(
        summary,
        ["metric", "value"],
        [
            ("Total Clients", text("total_clients")),
            ("Clients Churned", text("churned_clients")),
            ("Clients in Risk of Churn", text("at_risk_clients")),
            ("High Risk (>60 days)", text("high_risk_clients")),
            ("Medium Risk (31-60 days)", text("medium_risk_clients")),
            ("Low Risk (≤30 days)", text("low_risk_clients")),
            ("Unknown Risk", text("unknown_risk_clients")),
            (
                "Avg Days Since Last Event (Active)",
                F.call_function("format_number", F.col("avg_days_active"), F.lit("0.0")),
            ),
            ("Churn Rate", percent_text(ratio(F.col("churned_clients"), F.col("total_clients")))),
        ],
    )


def churn_insights(summary: DataFrame) -> DataFrame:
    """One row: churned, at-risk and high-risk clients with percentages."""
    total = F.col("total_clients")
    return summary.select(
        "churned_clients",
        "at_risk_clients",
        "high_risk_clients",
        (ratio(F.col("churned_clients"), total) * 100).alias("churn_rate"),
        (ratio(F.col("at_risk_clients"), total) * 100).alias("at_risk_percentage"),
        (ratio(F.col("high_risk_clients"), total) * 100).alias("high_risk_percentage"),
        "avg_days_active",
    )


def churned_vs_at_risk(summary: DataFrame) -> DataFrame:
    return to_rows(
        summary,
        ["category", "clients"],
        [
            ("Clients Churned", F.col("churned_clients")),
            ("Clients in Risk of Churn", F.col("at_risk_clients")),
        ],
    )


def risk_distribution(risk: DataFrame) -> DataFrame:
    """Clients per risk category, without churned clients."""
    return (
        risk.where(~_is(ALREADY_CHURNED))
        .groupBy("risk_category")
        .agg(F.count(F.lit(1)).alias("clients"))
        .orderBy(F.desc("clients"), "risk_category")
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in `bins` equal bins from the minimum to the maximum, empty bins included.

    The maximum belongs to the last bin, and all values to the first one if they are equal; no values
    give no rows. The limits come from a one-row scalar subquery.
    """
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull())
    limits = values.agg(
        F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("limits")
    )
    lo, hi = F.col("limits.lo"), F.col("limits.hi")
    width = (hi - lo) / bins
    position = F.floor((F.col("value") - lo) / F.nullif(width, F.lit(0.0)))
    counts = (
        values.withColumn("limits", limits.scalar())
        .groupBy(
            F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"),
            "limits",
        )
        .agg(F.count(F.lit(1)).alias("clients"))
    )
    # One row with at most `bins` counts, from which every bin takes its own.
    filled = counts.groupBy("limits").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "clients"))).alias("filled")
    )
    return (
        filled.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .withColumn("clients", F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)))
        .select(
            "bin",
            (lo + F.col("bin") * width).alias("bin_start"),
            F.when(F.col("bin") == bins - 1, hi)
            .otherwise(lo + (F.col("bin") + 1) * width)
            .alias("bin_end"),
            "clients",
        )
        .orderBy("bin")
    )


def idle_histogram(risk: DataFrame, bins: int = 30) -> DataFrame:
    """Days since the last event of clients who have not churned."""
    return histogram(risk.where(~_is(ALREADY_CHURNED)), "days_since_last_event", bins)


def signed_histogram(churn: DataFrame, bins: int = 25) -> DataFrame:
    """Days since signing."""
    return histogram(churn, "days_since_signed", bins)


def churn_client_table(risk: DataFrame) -> DataFrame:
    """Dates, days and risk per client as text, highest risk and longest idle first."""
    idle_days = F.col("days_since_last_event").cast("bigint")
    signed_days = F.col("days_since_signed").cast("bigint")
    priority = F.array_position(F.array(*[F.lit(r) for r in RISKS]), F.col("risk_category"))
    dates = ["applied_date", "signed_date", "last_event_date", "churned_date"]
    return risk.orderBy(
        priority,
        F.desc(F.coalesce(idle_days, F.lit(MISSING_DAYS_SORT_AS))),
        "client_id",
        "last_event_type",
    ).select(
        F.col("client_id").cast("string").alias("client_id"),
        *[date_text(F.col(c)).alias(c) for c in dates],
        F.coalesce(idle_days.cast("string"), F.lit("-")).alias("days_since_last_event"),
        F.coalesce(signed_days.cast("string"), F.lit("-")).alias("days_since_signed"),
        "last_event_type",
        "risk_category",
    )


def last_event_monthly(churn: DataFrame) -> DataFrame:
    """Last events per month."""
    return (
        churn.where(F.col("last_event_date").isNotNull())
        .groupBy(month_text(F.col("last_event_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("last_events"))
        .orderBy("month")
    )


def latest_region(events: DataFrame) -> DataFrame:
    """The region on each client's latest record."""
    return _latest(events, "region").groupBy("client_id").agg(_value_of_latest("region").alias("region"))


def risk_by_region(risk: DataFrame, regions: DataFrame) -> DataFrame:
    """Clients per region and risk category, one column per category."""
    return (
        risk.select("client_id", "risk_category")
        .join(regions.where(F.col("region").isNotNull()), "client_id")
        .groupBy("region")
        .agg(*[F.count_if(_is(r)).alias(r.lower().replace(" ", "_")) for r in RISKS])
        .orderBy("region")
    )
