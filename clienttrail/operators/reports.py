"""Tables of the data-quality report, derived from findings, event distribution and details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clienttrail.functions import date_text, month_text, ratio
from clienttrail.operators.checks import (
    DOCS_PATTERN,
    HAS_DOCS,
    LONG_INACTIVE,
    CHURNED_WITHOUT_SIGNED,
    MULTIPLE_APPLICATIONS,
    SEQUENCE_VIOLATION,
    SIGNED_WITHOUT_APPLIED,
    SIGNED_WITHOUT_DOCS,
    UNKNOWN_VALUES,
)
from clienttrail.operators.shape import to_rows
from clienttrail.schema import APPLIED, DOCS_SUBMITTED

# Business question and severity per finding type.
QUESTIONS = {
    MULTIPLE_APPLICATIONS: "Q1: Multiple applied events",
    SIGNED_WITHOUT_APPLIED: "Q2: Signed without applying",
    CHURNED_WITHOUT_SIGNED: "Q3: Churned without signing",
    LONG_INACTIVE: "Q6: Long inactive unsigned",
}
SEVERITIES = {
    MULTIPLE_APPLICATIONS: "Medium",
    SIGNED_WITHOUT_APPLIED: "High",
    CHURNED_WITHOUT_SIGNED: "High",
    LONG_INACTIVE: "Low",
}
SCENARIO_TYPES = (UNKNOWN_VALUES, SEQUENCE_VIOLATION, DOCS_PATTERN, MULTIPLE_APPLICATIONS)


def _is(finding_type: str) -> Column:
    return F.col("inconsistency_type") == finding_type


def _lookup(values: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(_is(k), F.lit(v)) for k, v in values.items()])


def _counts(df: DataFrame, key: str | Column, name: str = "cases") -> DataFrame:
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), counted.columns[0])


def unknown_reason_counts(findings: DataFrame) -> DataFrame:
    """Records per reason of an unknown value."""
    return _counts(findings.where(_is(UNKNOWN_VALUES)), "description", "records")


def docs_pattern_counts(findings: DataFrame) -> DataFrame:
    """Clients per document submission pattern."""
    return _counts(findings.where(_is(DOCS_PATTERN)), "description", "clients")


def question_counts(findings: DataFrame) -> DataFrame:
    """Cases per business question."""
    default = F.concat(F.lit("Unknown: "), F.col("inconsistency_type"))
    return _counts(findings, F.coalesce(_lookup(QUESTIONS), default).alias("business_question"))


def severity_counts(findings: DataFrame) -> DataFrame:
    """Cases per severity; types without a severity are left out."""
    rated = findings.where(F.col("inconsistency_type").isin(*SEVERITIES))
    return _counts(rated, _lookup(SEVERITIES).alias("severity"))


def violation_points(findings: DataFrame) -> DataFrame:
    """First application and signature of clients with a sequence violation, one row each."""
    return to_rows(
        findings.where(_is(SEQUENCE_VIOLATION)),
        ["event", "event_date"],
        [("Applied", F.col("first_applied_date")), ("Signed", F.col("first_signed_date"))],
        keep=["client_id", "violation_type"],
    ).where(F.col("event_date").isNotNull())


def application_spread(findings: DataFrame) -> DataFrame:
    """Number of applications and their time spread per client."""
    return findings.where(_is(MULTIPLE_APPLICATIONS)).select(
        "client_id", "application_count", "date_range_days"
    )


def event_type_counts(distribution: DataFrame) -> DataFrame:
    """Events and clients per event type, most frequent first; of event numbers or a distribution."""
    return distribution.select("event_type", "event_count", "unique_clients").orderBy(
        F.desc("event_count"), "event_type"
    )


def _scenario_counts(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("inconsistency_type").isin(*SCENARIO_TYPES)).agg(
        F.count_if(_is(UNKNOWN_VALUES)).alias("unknown_records"),
        F.count_if(_is(SEQUENCE_VIOLATION)).alias("sequence_clients"),
        F.count_if(_is(DOCS_PATTERN) & (F.col("description") == HAS_DOCS)).alias("docs_clients"),
        F.count_if(_is(DOCS_PATTERN) & (F.col("description") == SIGNED_WITHOUT_DOCS)).alias(
            "signed_without_docs_clients"
        ),
        F.count_if(_is(MULTIPLE_APPLICATIONS)).alias("multiple_application_clients"),
    )


def scenario_summary(findings: DataFrame) -> DataFrame:
    """The scenarios with their counts and descriptions."""
    return to_rows(
        _scenario_counts(findings),
        ["scenario", "cases", "description"],
        [
            (
                "Scenario 1: Unknown Values",
                F.col("unknown_records"),
                "Records with missing/unknown field values",
            ),
            (
                "Scenario 2: Date Sequence Violations",
                F.col("sequence_clients"),
                "Events in wrong chronological order",
            ),
            (
                "Scenario 3a: Has Document Submission",
                F.col("docs_clients"),
                "Clients who submitted documents",
            ),
            (
                "Scenario 3b: Missing Document Submission",
                F.col("signed_without_docs_clients"),
                "Clients signed without docs submission",
            ),
            (
                "Scenario 4: Multiple Applications",
                F.col("multiple_application_clients"),
                "Clients with multiple application events",
            ),
        ],
    )


def scenario_insights(findings: DataFrame, distribution: DataFrame) -> DataFrame:
    """One row: the scenario counts and docs events per applied event.

    The distribution has a row (event_type, event_count) for each type.
    """
    counts = _scenario_counts(findings)
    names = counts.columns

    def count_of(event_type: str) -> Column:
        value = F.max(F.when(F.col("event_type") == event_type, F.col("event_count")))
        return F.coalesce(value, F.lit(0).cast("bigint"))

    event_counts = distribution.agg(
        count_of(DOCS_SUBMITTED).alias("docs_events"), count_of(APPLIED).alias("applied_events")
    )
    both = counts.unionByName(event_counts, allowMissingColumns=True)
    return both.agg(
        *[F.sum(c).alias(c) for c in (*names, "docs_events", "applied_events")]
    ).withColumn("docs_rate", ratio(F.col("docs_events"), F.col("applied_events")))


def problem_events(findings: DataFrame, ordered: bool = True) -> DataFrame:
    """The problem table as text: one row per finding of the four scenarios."""

    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("-"))

    def label(prefix: str, value: Column) -> Column:
        return F.concat(F.lit(prefix), value)

    dash = F.lit("-")
    applied, signed = date_text(F.col("first_applied_date")), date_text(F.col("first_signed_date"))
    # Per type: issue, details, date, additional info, sales rep.
    columns = {
        UNKNOWN_VALUES: (
            F.lit("Unknown Values"),
            F.col("event_type"),
            date_text(F.col("event_date")),
            F.col("plan"),
            text("sales_rep_id"),
        ),
        SEQUENCE_VIOLATION: (
            F.lit("Sequence Violation"),
            F.initcap(F.replace("violation_type", F.lit("_"), F.lit(" "))),
            F.concat(F.lit("Applied: "), applied, F.lit(", Signed: "), signed),
            dash,
            dash,
        ),
        MULTIPLE_APPLICATIONS: (
            F.lit("Multiple Applications"),
            F.concat(text("application_count"), F.lit(" applications")),
            date_text(F.col("relevant_date")),
            F.coalesce(F.concat(F.col("date_range_days").cast("string"), F.lit(" days")), dash),
            dash,
        ),
        DOCS_PATTERN: (
            F.lit("Document Pattern"),
            F.concat_ws(
                ", ",
                label("Applied: ", text("applied_count")),
                label("Docs: ", text("docs_count")),
                label("Signed: ", text("signed_count")),
            ),
            label("Applied: ", date_text(F.col("first_applied"))),
            label("Signed: ", date_text(F.col("first_signed"))),
            dash,
        ),
    }
    names = ("issue_type", "event_details", "date_info", "additional_info", "sales_rep")
    shown = findings.where(F.col("inconsistency_type").isin(*columns)).select(
        "client_id",
        *[
            F.coalesce(*[F.when(_is(t), values[i]) for t, values in columns.items()]).alias(name)
            for i, name in enumerate(names)
        ],
        "description",
        "record_id",
    )
    if ordered:
        # The hash makes the order of tied rows a function of the rows, whichever task sorts them.
        shown = shown.orderBy("issue_type", "client_id", "record_id", F.xxhash64(*shown.columns))
    return shown.select(F.col("client_id").cast("string").alias("client_id"), *names, "description")


def affected_monthly_counts(counts: DataFrame) -> DataFrame:
    """Events of affected clients per month, from their counts per client and month."""
    return counts.groupBy("month").agg(F.sum("events").alias("events")).orderBy("month")


def affected_monthly(details: DataFrame) -> DataFrame:
    """Events of affected clients per month."""
    return (
        details.where(F.col("event_date").isNotNull())
        .groupBy(month_text(F.col("event_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("month")
    )


def affected_sample(details: DataFrame, rows: int = 10) -> DataFrame:
    """The first events of affected clients, by client and date."""
    return (
        details.orderBy("client_id", "event_date", "record_id")
        .limit(rows)
        .select(
            F.coalesce(F.col("client_id").cast("string"), F.lit("-")).alias("client_id"),
            F.coalesce("event_type", F.lit("-")).alias("event_type"),
            date_text(F.col("event_date")).alias("event_date"),
        )
    )
