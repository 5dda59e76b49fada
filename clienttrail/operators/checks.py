"""Data-quality checks over lifecycle events.

A finding carries `client_id, inconsistency_type, description` and the columns of its check. Checks
of one client's history are conditions on the client profile, so the union of all of them costs one
aggregation of the events instead of one per check. Findings are unordered; `in_report_order` sorts.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clienttrail.functions import as_of_literal, elapsed_days_sql, month_text
from clienttrail.operators.profile import client_plan_profile, client_profile
from clienttrail.schema import (
    DETAILS_SCHEMA,
    DOCS_SUBMITTED,
    FINDINGS_SCHEMA,
    NO_SALES_REP,
    UNKNOWN,
    UNKNOWN_PLAN,
)

# Finding types and descriptions, in report order.
CHURNED_WITHOUT_SIGNED = "Q3_churned_without_signed"
LONG_INACTIVE = "Q6_long_inactive_unsigned"
SIGNED_WITHOUT_APPLIED = "Q2_signed_without_applied"
MULTIPLE_APPLICATIONS = "Q1_multiple_applications"
UNKNOWN_VALUES = "unknown_values"
SEQUENCE_VIOLATION = "sequence_violation"
DOCS_PATTERN = "docs_submitted_analysis"
PLAN_INCONSISTENCY = "plan_inconsistency"
FINDING_TYPES = (
    CHURNED_WITHOUT_SIGNED,
    LONG_INACTIVE,
    SIGNED_WITHOUT_APPLIED,
    MULTIPLE_APPLICATIONS,
    UNKNOWN_VALUES,
    SEQUENCE_VIOLATION,
    DOCS_PATTERN,
    PLAN_INCONSISTENCY,
)
SIGNED_WITHOUT_DOCS = "Applied and signed without docs submission"
PENDING_WITHOUT_DOCS = "Applied but no docs submission (still pending?)"
HAS_DOCS = "Has docs submission event"
OTHER_DOCS_PATTERN = "Other pattern"
LONG_INACTIVE_DAYS = 60

_KEYS = ("client_id", "inconsistency_type", "description")


class _ClientCheck(NamedTuple):
    """A check of one client's history: SQL over the client profile."""

    fires: str
    description: str
    fields: dict[str, str]


_CHURNED_WITHOUT_SIGNED = _ClientCheck(
    "churned_count > 0 AND signed_count = 0",
    "'Client churned without ever signing'",
    {
        "relevant_date": "first_churned",
        "signed_count": "signed_count",
        "churned_count": "churned_count",
    },
)

_SIGNED_WITHOUT_APPLIED = _ClientCheck(
    "signed_count > 0 AND applied_count = 0",
    "'Client signed without applying first'",
    {
        "relevant_date": "first_signed",
        "applied_count": "applied_count",
        "signed_count": "signed_count",
    },
)

_MULTIPLE_APPLICATIONS = _ClientCheck(
    "applied_count > 1",
    "'Client has multiple application events'",
    {
        "relevant_date": "first_applied",
        "application_count": "applied_count",
        "date_range_days": f"cast({elapsed_days_sql('first_applied', 'last_applied')} AS int)",
    },
)

_DOCS_PATTERN = _ClientCheck(
    "applied_count > 0",
    f"""CASE WHEN docs_count > 0 THEN '{HAS_DOCS}'
             WHEN signed_count > 0 THEN '{SIGNED_WITHOUT_DOCS}'
             WHEN rejected_count = 0 THEN '{PENDING_WITHOUT_DOCS}'
             ELSE '{OTHER_DOCS_PATTERN}' END""",
    {
        "applied_count": "applied_count",
        "docs_count": "docs_count",
        "signed_count": "signed_count",
        "rejected_count": "rejected_count",
        "first_applied": "first_applied",
        "first_signed": "first_signed",
    },
)

# Condition, name and description of each violation; the first that holds counts.
# Comparisons with a missing date do not hold.
_VIOLATIONS = (
    ("first_signed < first_applied", "signed_before_applied", "Client signed before applying"),
    (
        "first_docs < first_applied",
        "docs_submitted_before_applied",
        "Client submitted docs before applying",
    ),
    (
        "first_rejected < first_applied",
        "rejected_before_applied",
        "Client was rejected before applying",
    ),
    ("first_churned < first_signed", "churned_before_signed", "Client churned before signing"),
)

_SEQUENCE = _ClientCheck(
    " OR ".join(f"coalesce({condition}, false)" for condition, _, _ in _VIOLATIONS),
    "CASE " + " ".join(f"WHEN {c} THEN '{text}'" for c, _, text in _VIOLATIONS) + " END",
    {
        "violation_type": "CASE "
        + " ".join(f"WHEN {c} THEN '{name}'" for c, name, _ in _VIOLATIONS)
        + " END",
        "first_applied_date": "first_applied",
        "first_signed_date": "first_signed",
        "first_docs_date": "first_docs",
        "first_rejected_date": "first_rejected",
        "first_churned_date": "first_churned",
    },
)


_PLAN_CHANGES = _ClientCheck(
    "unique_plans > 1",
    "'Client has multiple different plans across events'",
    {
        "unique_plans": "unique_plans",
        "all_plans": "array_join(plans, ',')",
        "first_event": "first_event",
        "last_event": "last_event",
    },
)


def _long_inactive(as_of: datetime | str) -> _ClientCheck:
    idle = elapsed_days_sql("last_event", as_of_literal(as_of))
    return _ClientCheck(
        f"signed_count = 0 AND {idle} > {LONG_INACTIVE_DAYS}",
        "'Unsigned client with long inactivity (>60 days) - potential at-risk'",
        {
            "relevant_date": "last_event",
            "days_inactive": f"cast({idle} AS int)",
            "signed_count": "signed_count",
        },
    )


def _single(events: DataFrame, finding_type: str, check: _ClientCheck) -> DataFrame:
    return (
        client_profile(events)
        .where(check.fires)
        .selectExpr(
            "client_id",
            f"'{finding_type}' AS inconsistency_type",
            f"{check.description} AS description",
            *[f"{sql} AS {name}" for name, sql in check.fields.items()],
        )
    )


def churned_without_signed(events: DataFrame) -> DataFrame:
    return _single(events, CHURNED_WITHOUT_SIGNED, _CHURNED_WITHOUT_SIGNED)


def long_inactive_unsigned(events: DataFrame, as_of: datetime | str) -> DataFrame:
    return _single(events, LONG_INACTIVE, _long_inactive(as_of))


def signed_without_applied(events: DataFrame) -> DataFrame:
    return _single(events, SIGNED_WITHOUT_APPLIED, _SIGNED_WITHOUT_APPLIED)


def multiple_applications(events: DataFrame) -> DataFrame:
    return _single(events, MULTIPLE_APPLICATIONS, _MULTIPLE_APPLICATIONS)


def sequence_violations(events: DataFrame) -> DataFrame:
    return _single(events, SEQUENCE_VIOLATION, _SEQUENCE)


def docs_submitted_pattern(events: DataFrame) -> DataFrame:
    return _single(events, DOCS_PATTERN, _DOCS_PATTERN)


def unknown_values(events: DataFrame, strict: bool = False) -> DataFrame:
    """Records with a missing or default value; the first matching reason is the description.

    Staging fills channel and source with `unknown`, which only `strict` reports. Narrow.
    """

    def missing(column: str) -> Column:
        absent = F.col(column).isNull() | (F.col(column) == "")
        return absent | (F.col(column) == UNKNOWN) if strict else absent

    reasons = (
        (F.col("plan") == UNKNOWN_PLAN, "Plan field has Unknown value"),
        (F.col("sales_rep_id") == NO_SALES_REP, "Sales rep ID is -1 (missing/unknown)"),
        (missing("region"), "Region field is missing"),
        (missing("marketing_channel"), "Marketing channel is missing"),
        (missing("source_system"), "Source system is missing"),
    )
    reason = F.coalesce(*[F.when(cond, F.lit(text)) for cond, text in reasons])
    return events.where(reason.isNotNull()).select(
        "client_id",
        "record_id",
        "event_type",
        "event_date",
        F.lit(UNKNOWN_VALUES).alias("inconsistency_type"),
        reason.alias("description"),
        "plan",
        "sales_rep_id",
        "region",
        "marketing_channel",
        "source_system",
    )


def plan_changes(events: DataFrame) -> DataFrame:
    """Clients with more than one plan and the sorted list of their plans.

    Events shrink to one row per client and plan before the plans of a client meet, so the lists
    grow with the plan vocabulary only. A window collects them, as sorted rows are cheaper here
    than the per-client objects of a collecting aggregation.
    """
    by_plan = events.groupBy("client_id", "plan").agg(
        F.min("event_date").alias("first"), F.max("event_date").alias("last")
    )
    by_name = Window.partitionBy("client_id").orderBy("plan")
    client = by_name.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        by_plan.select(
            "client_id",
            F.row_number().over(by_name).alias("position"),
            F.count("plan").over(client).alias("unique_plans"),
            F.collect_list("plan").over(client).alias("plans"),
            F.min("first").over(client).alias("first_event"),
            F.max("last").over(client).alias("last_event"),
        )
        .where((F.col("position") == 1) & (F.col("unique_plans") > 1))
        .select(
            "client_id",
            F.lit(PLAN_INCONSISTENCY).alias("inconsistency_type"),
            F.lit("Client has multiple different plans across events").alias("description"),
            "unique_plans",
            F.array_join("plans", ",").alias("all_plans"),
            "first_event",
            "last_event",
        )
    )


def docs_events(events: DataFrame) -> DataFrame:
    """All docs_submitted events."""
    return events.where(F.col("event_type") == DOCS_SUBMITTED).select(
        "client_id",
        F.col("event_date").alias("docs_submitted_date"),
        "plan",
        "region",
        "marketing_channel",
        "sales_rep_id",
        "source_system",
    )


def event_numbers(events: DataFrame) -> DataFrame:
    """Counts, clients, date range and mean sales rep per event type.

    Events shrink by type and client, for the exact client count, before they shuffle.
    """
    return numbers_of_types(events.groupBy("event_type", "client_id").agg(*client_numbers()))


def client_numbers() -> list[Column]:
    """What is kept of a client's events of one type; all of it can be merged."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.min("event_date").alias("first"),
        F.max("event_date").alias("last"),
        F.sum("sales_rep_id").alias("rep_sum"),
        F.count("sales_rep_id").alias("rep_n"),
    ]


def numbers_of_types(by_client: DataFrame) -> DataFrame:
    """event_numbers() from one row of client_numbers() per event type and client."""
    return by_client.groupBy("event_type").agg(
        F.sum("n").alias("event_count"),
        F.count("client_id").alias("unique_clients"),
        F.min("first").alias("earliest_date"),
        F.max("last").alias("latest_date"),
        F.round(F.try_divide(F.sum("rep_sum").cast("double"), F.sum("rep_n")), 2).alias(
            "avg_sales_rep_id"
        ),
    )


def event_distribution(events: DataFrame) -> DataFrame:
    """The numbers of each event type, and the plans and regions that occur with it.

    Two aggregations that both shrink before they shuffle: the numbers, and one by type, plan and
    region for the lists.
    """
    return with_value_lists(event_numbers(events), events)


def with_value_lists(numbers: DataFrame, values: DataFrame) -> DataFrame:
    """Add to the numbers of event types the plans and regions that occur with them in values."""

    def distinct_list(column: str) -> Column:
        values = F.collect_set(column)
        return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), ","))

    lists = (
        values.select(F.col("event_type").alias("_type"), "plan", "region")
        .distinct()
        .groupBy("_type")
        .agg(
            distinct_list("plan").alias("plans_involved"),
            distinct_list("region").alias("regions_involved"),
        )
    )
    return (
        numbers.join(lists, F.col("event_type").eqNullSafe(F.col("_type")))
        .drop("_type")
        .orderBy(F.desc("event_count"), "event_type")
    )


def inconsistencies(
    events: DataFrame, as_of: datetime | str, types: Collection[str] | None = None
) -> DataFrame:
    """Findings of the given types (None: all) under one fixed schema.

    Only what the types need is read and aggregated.

    Each client's profile yields one row per check that fires; unknown values, which are of records and
    not of clients, are added by name. All checks together read the events twice and shuffle them once, for
    the profile. No distinct: a client or record is listed once per finding.
    """
    checks = {
        CHURNED_WITHOUT_SIGNED: _CHURNED_WITHOUT_SIGNED,
        LONG_INACTIVE: _long_inactive(as_of),
        SIGNED_WITHOUT_APPLIED: _SIGNED_WITHOUT_APPLIED,
        MULTIPLE_APPLICATIONS: _MULTIPLE_APPLICATIONS,
        SEQUENCE_VIOLATION: _SEQUENCE,
        DOCS_PATTERN: _DOCS_PATTERN,
    }
    wanted = FINDING_TYPES if types is None else types
    if unknown := set(wanted) - set(FINDING_TYPES):
        raise ValueError(f"unknown finding types: {', '.join(sorted(unknown))}")
    checks = {name: c for name, c in checks.items() if name in wanted}
    plans = PLAN_INCONSISTENCY in wanted
    if checks and plans:
        profile = client_plan_profile(events)
        parts = [_client_findings(profile, checks | {PLAN_INCONSISTENCY: _PLAN_CHANGES})]
    elif checks:
        parts = [_client_findings(client_profile(events), checks)]
    else:
        parts = [plan_changes(events)] if plans else []
    if UNKNOWN_VALUES in wanted:
        parts.append(unknown_values(events))
    if not parts:
        raise ValueError("no finding types")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.selectExpr(
        *[
            f"cast({f.name if f.name in union.columns else 'null'} AS {f.dataType.simpleString()})"
            f" AS {f.name}"
            for f in FINDINGS_SCHEMA
        ]
    )


def _client_findings(profile: DataFrame, checks: dict[str, _ClientCheck]) -> DataFrame:
    """A row for each client and each of the checks on its profile that fires."""
    fired = ", ".join(f"CASE WHEN {c.fires} THEN '{name}' END" for name, c in checks.items())

    def of_check(sql_of: dict[str, str]) -> str:
        cases = [f"WHEN '{name}' THEN {sql}" for name, sql in sql_of.items()]
        return f"CASE inconsistency_type {' '.join(cases)} END"

    fields = dict.fromkeys(f for check in checks.values() for f in check.fields)
    return (
        profile.selectExpr("*", f"explode(array({fired})) AS inconsistency_type")
        .where("inconsistency_type IS NOT NULL")
        .selectExpr(
            "client_id",
            "inconsistency_type",
            of_check({n: c.description for n, c in checks.items()}) + " AS description",
            *[
                of_check({n: c.fields[f] for n, c in checks.items() if f in c.fields}) + f" AS {f}"
                for f in fields
            ],
        )
    )


def in_report_order(findings: DataFrame) -> DataFrame:
    """Sort findings of one or all checks as the report lists them."""
    columns = findings.columns
    keys = [F.array_position(F.array(*map(F.lit, FINDING_TYPES)), F.col("inconsistency_type"))]
    if "docs_count" in columns:
        keys.append(
            F.when(F.col("docs_count") > 0, 1).when(F.col("signed_count") > 0, 2).otherwise(3)
        )
    if "unique_plans" in columns:
        keys.append(F.desc("unique_plans"))
    keys += [F.col(c) for c in ("client_id", "event_date", "record_id") if c in columns]
    # The hash makes the order of tied rows a function of the rows, whichever task sorts them.
    return findings.orderBy(*keys, F.xxhash64(*columns))


def inconsistency_counts(findings: DataFrame) -> DataFrame:
    return (
        findings.groupBy("inconsistency_type")
        .agg(F.count(F.lit(1)).alias("cases"))
        .orderBy(F.desc("cases"), "inconsistency_type")
    )


def first_affected_events(events: DataFrame, findings: DataFrame, clients: int) -> DataFrame:
    """Events of the affected clients with the smallest ids; every affected client has an event."""
    ids = findings.where(F.col("client_id").isNotNull()).select("client_id").distinct()
    first = ids.orderBy("client_id").limit(clients)
    # At most `clients` ids.
    return events.join(F.broadcast(first), "client_id", "left_semi")


def affected_month_counts(events: DataFrame, findings: DataFrame) -> DataFrame:
    """Events of affected clients per client and month, counted before they meet the findings."""
    monthly = (
        events.where(F.col("event_date").isNotNull())
        .groupBy("client_id", month_text(F.col("event_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    affected = findings.select("client_id").distinct()
    return monthly.join(affected, "client_id", "left_semi")


def client_event_details(staged: DataFrame, findings: DataFrame) -> DataFrame:
    """Staged events of every client with a finding.

    The ids shrink to a few per client before they meet the events. They are made distinct by type
    as well, which leaves them to be shuffled by the join itself: only a join that reads both its
    sides straight from a shuffle is split by adaptive execution when one client has very many
    events.
    """
    affected = findings.select("client_id", "inconsistency_type").distinct().select("client_id")
    return staged.join(affected, "client_id", "left_semi").select(
        *[c for c in DETAILS_SCHEMA.names if c in staged.columns]
    )
