"""Funnel: first date per stage, conversion metrics and the tables of the funnel report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clienttrail.functions import date_text, month_text, percent_text, ratio, whole_days
from clienttrail.operators.profile import client_profile
from clienttrail.operators.shape import to_rows

# Labels of the funnel report.
TRANSITIONS = (
    ("Applied → Docs", "applied_date", "docs_submitted_date"),
    ("Applied → Rejected", "applied_date", "rejected_date"),
    ("Applied → Signed", "applied_date", "signed_date"),
    ("Signed → Churned", "signed_date", "churned_date"),
)
STAGE_COUNTS = (
    ("Applied", "applied_clients"),
    ("Docs Submitted", "docs_submitted_clients"),
    ("Rejected", "rejected_clients"),
    ("Signed", "signed_clients"),
    ("Churned", "churned_clients"),
    ("Active", "active_clients"),
)
RATES = (
    ("Application Rate", "application_rate"),
    ("Docs Submission Rate", "docs_submission_rate"),
    ("Rejection Rate", "rejection_rate"),
    ("Conversion Rate", "conversion_rate"),
    ("Churn Rate", "churn_rate"),
)


def client_funnel(events: DataFrame) -> DataFrame:
    """First date per stage and client.

    The earliest event of a type is the one ranked 1, so no rank is needed here.
    """
    return client_profile(events).select(
        "client_id",
        F.col("first_applied").alias("applied_date"),
        F.col("first_docs").alias("docs_submitted_date"),
        F.col("first_rejected").alias("rejected_date"),
        F.col("first_signed").alias("signed_date"),
        F.col("first_churned").alias("churned_date"),
    )


def funnel_metrics(funnel: DataFrame) -> DataFrame:
    """One row: clients per stage, guarded rates and active clients."""
    total, applied = F.col("total_clients"), F.col("applied_clients")
    signed, churned = F.col("signed_clients"), F.col("churned_clients")
    return funnel.agg(
        F.count(F.lit(1)).alias("total_clients"),
        F.count("applied_date").alias("applied_clients"),
        F.count("docs_submitted_date").alias("docs_submitted_clients"),
        F.count("rejected_date").alias("rejected_clients"),
        F.count("signed_date").alias("signed_clients"),
        F.count("churned_date").alias("churned_clients"),
    ).select(
        "*",
        ratio(applied, total).alias("application_rate"),
        ratio(F.col("docs_submitted_clients"), applied).alias("docs_submission_rate"),
        ratio(F.col("rejected_clients"), applied).alias("rejection_rate"),
        ratio(signed, applied).alias("conversion_rate"),
        ratio(churned, signed).alias("churn_rate"),
        F.greatest(signed - churned, F.lit(0).cast("bigint")).alias("active_clients"),
    )


def funnel_overview(metrics: DataFrame) -> DataFrame:
    """Clients per stage, one row per stage."""
    return to_rows(metrics, ["stage", "clients"], [(s, F.col(c)) for s, c in STAGE_COUNTS])


def funnel_waterfall(metrics: DataFrame) -> DataFrame:
    """As the overview, with all clients as the first stage."""
    stages = (("Total Clients", "total_clients"), *STAGE_COUNTS)
    return to_rows(metrics, ["stage", "clients"], [(s, F.col(c)) for s, c in stages])


def funnel_rates(metrics: DataFrame) -> DataFrame:
    """Rates in percent with their labels, one row per rate."""
    return to_rows(
        metrics,
        ["rate_type", "percentage", "label"],
        [(name, F.col(c) * 100, percent_text(F.col(c))) for name, c in RATES],
    )


def funnel_summary(metrics: DataFrame) -> DataFrame:
    """The summary table: metric name and its value as text."""

    def share(count: str, rate: str):
        percent = percent_text(F.col(rate))
        return F.concat(F.col(count).cast("string"), F.lit(" ("), percent, F.lit(")"))

    return to_rows(
        metrics,
        ["metric", "value"],
        [
            ("Total Clients", F.col("total_clients").cast("string")),
            ("Applied Clients", share("applied_clients", "application_rate")),
            ("Docs Submitted", share("docs_submitted_clients", "docs_submission_rate")),
            ("Rejected Clients", share("rejected_clients", "rejection_rate")),
            ("Signed Clients", share("signed_clients", "conversion_rate")),
            ("Churned Clients", share("churned_clients", "churn_rate")),
            ("Active Clients", F.col("active_clients").cast("string")),
            ("Success Rate: Applied → Signed", percent_text(F.col("conversion_rate"))),
            ("Retention Rate: Signed → Active", percent_text(1 - F.col("churn_rate"))),
        ],
    )


def funnel_insights(metrics: DataFrame) -> DataFrame:
    """One row: conversion, drop-off, churn and retention."""
    return metrics.select(
        "conversion_rate",
        (1 - F.col("conversion_rate")).alias("drop_off_rate"),
        "churn_rate",
        (1 - F.col("churn_rate")).alias("retention_rate"),
    )


def stage_durations(funnel: DataFrame) -> DataFrame:
    """Whole days per client and transition, where both dates are known."""
    rows = [(stage, whole_days(a, b)) for stage, a, b in TRANSITIONS]
    return to_rows(funnel, ["stage", "days"], rows, keep=["client_id"]).where(
        F.col("days").isNotNull()
    )


def stage_duration_stats(durations: DataFrame) -> DataFrame:
    """Exact quartiles and extremes per transition.

    Equal durations are counted first, so the percentile sees one row per distinct day count.
    """
    counted = durations.groupBy("stage", "days").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.groupBy("stage")
        .agg(
            F.sum("n").alias("clients"),
            F.min("days").alias("min_days"),
            F.percentile("days", [0.25, 0.5, 0.75], F.col("n")).alias("q"),
            F.max("days").alias("max_days"),
        )
        .select(
            "stage",
            "clients",
            "min_days",
            F.col("q")[0].alias("q1_days"),
            F.col("q")[1].alias("median_days"),
            F.col("q")[2].alias("q3_days"),
            "max_days",
        )
    )


def journey_types(funnel: DataFrame) -> DataFrame:
    """Clients per kind of journey; the first matching kind counts."""
    rejected, churned = F.col("rejected_date").isNotNull(), F.col("churned_date").isNotNull()
    docs, signed = F.col("docs_submitted_date").isNotNull(), F.col("signed_date").isNotNull()
    applied = F.col("applied_date").isNotNull()
    kind = (
        F.when(rejected, "Rejected (Applied → Rejected)")
        .when(churned & docs, "Full Journey with Docs (Applied → Docs → Signed → Churned)")
        .when(churned, "Full Journey (Applied → Signed → Churned)")
        .when(signed & docs, "Active with Docs (Applied → Docs → Signed)")
        .when(signed, "Active Client (Applied → Signed)")
        .when(docs, "Docs Submitted (Applied → Docs)")
        .when(applied, "Applied Only (No Progress)")
        .otherwise("Other")
    )
    return (
        funnel.groupBy(kind.alias("journey_type"))
        .agg(F.count(F.lit(1)).alias("clients"))
        .orderBy(F.desc("clients"), "journey_type")
    )


def funnel_client_table(funnel: DataFrame) -> DataFrame:
    """Stage dates per client as text, earliest application first, no application last."""
    days_to_sign = whole_days("applied_date", "signed_date")
    days_to_churn = whole_days("signed_date", "churned_date")
    dates = ["applied_date", "docs_submitted_date", "rejected_date", "signed_date", "churned_date"]
    return funnel.orderBy(F.asc_nulls_last(F.col("applied_date").cast("date")), "client_id").select(
        F.col("client_id").cast("string").alias("client_id"),
        *[date_text(F.col(c)).alias(c) for c in dates],
        F.coalesce(days_to_sign.cast("string"), F.lit("-")).alias("days_to_sign"),
        F.coalesce(days_to_churn.cast("string"), F.lit("-")).alias("days_to_churn"),
    )


def funnel_monthly(funnel: DataFrame) -> DataFrame:
    """Applications and, among clients who applied, signatures per month."""
    events = to_rows(
        funnel.where(F.col("applied_date").isNotNull()),
        ["month", "is_signing"],
        [
            (month_text(F.col("applied_date")), F.lit(False)),
            (month_text(F.col("signed_date")), F.lit(True)),
        ],
    ).where(F.col("month").isNotNull())
    return (
        events.groupBy("month")
        .agg(
            F.count_if(~F.col("is_signing")).alias("applications"),
            F.count_if("is_signing").alias("conversions"),
        )
        .orderBy("month")
    )
