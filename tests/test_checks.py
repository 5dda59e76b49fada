from __future__ import annotations

from functools import reduce

import pytest
from fixtures import days, events, rows
from pyspark.sql import functions as F

from clienttrail.operators import checks, reports
from clienttrail.schema import FINDINGS_SCHEMA

AS_OF = "2023-03-02 12:00:00"

SINGLE_CHECKS = {
    checks.CHURNED_WITHOUT_SIGNED: checks.churned_without_signed,
    checks.LONG_INACTIVE: lambda df: checks.long_inactive_unsigned(df, AS_OF),
    checks.SIGNED_WITHOUT_APPLIED: checks.signed_without_applied,
    checks.MULTIPLE_APPLICATIONS: checks.multiple_applications,
    checks.UNKNOWN_VALUES: checks.unknown_values,
    checks.SEQUENCE_VIOLATION: checks.sequence_violations,
    checks.DOCS_PATTERN: checks.docs_submitted_pattern,
    checks.PLAN_INCONSISTENCY: checks.plan_changes,
}


@pytest.fixture(scope="module")
def odd(spark):
    """At least one finding of every kind."""
    return events(
        spark,
        (1, "churned", "2023-03-01"),
        (2, "signed", "2023-03-01"),
        (3, "applied", "2023-01-02"),
        (3, "docs_submitted", "2023-01-01"),
        (4, "applied", "2023-01-02"),
        (4, "rejected", "2023-01-01"),
        (5, "signed", "2023-01-02"),
        (5, "churned", "2023-01-01"),
        (6, "applied", "2023-01-02"),
        (6, "signed", "2023-01-01"),
        (6, "docs_submitted", "2022-12-01"),
        (7, "applied", "2023-01-01 20:00:00"),
        (7, "applied", "2023-01-03 06:00:00"),
        dict(client_id=7, event_type="signed", event_date="2023-01-04", plan="Basic"),
        dict(client_id=7, event_type="other", event_date="2023-01-05", plan=None),
        dict(client_id=8, event_type="applied", event_date="2023-03-01", region=None),
        dict(client_id=8, event_type="x", event_date="2023-03-01", marketing_channel=""),
        dict(client_id=8, event_type="x", event_date="2023-03-01", source_system=None),
        dict(client_id=8, event_type="x", event_date="2023-03-01", source_system="unknown"),
        dict(client_id=8, event_type="x", event_date="2023-03-01", plan="Unknown", sales_rep_id=-1),
        dict(client_id=8, event_type="x", event_date="2023-03-01", region="", sales_rep_id=-1),
        (9, "applied", "2022-12-01"),
    )


def test_churned_and_signed_without(odd):
    assert rows(checks.churned_without_signed(odd), "client_id", "relevant_date") == [
        (1, *days("2023-03-01"))
    ]
    assert rows(checks.signed_without_applied(odd), "client_id", "signed_count") == [(2, 1), (5, 1)]


def test_all_violations_first_match_wins(odd):
    assert rows(checks.sequence_violations(odd), "client_id", "violation_type", "description") == [
        (3, "docs_submitted_before_applied", "Client submitted docs before applying"),
        (4, "rejected_before_applied", "Client was rejected before applying"),
        (5, "churned_before_signed", "Client churned before signing"),
        (6, "signed_before_applied", "Client signed before applying"),
    ]


def test_unknown_values(odd):
    columns = ("client_id", "record_id", "description")
    assert rows(checks.unknown_values(odd), *columns) == [
        (8, 16, "Region field is missing"),
        (8, 17, "Marketing channel is missing"),
        (8, 18, "Source system is missing"),
        (8, 20, "Plan field has Unknown value"),
        (8, 21, "Sales rep ID is -1 (missing/unknown)"),
    ]
    assert (8, 19, "Source system is missing") in rows(checks.unknown_values(odd, True), *columns)


def test_application_span_is_cut_to_whole_days(odd):
    assert rows(
        checks.multiple_applications(odd), "client_id", "application_count", "date_range_days"
    ) == [(7, 2, 1)]


def test_inactivity_limit_is_fractional(spark):
    df = events(
        spark,
        (1, "applied", "2023-01-01 12:00:00"),
        (2, "applied", "2023-01-01 11:59:59.999999"),
        (3, "signed", "2022-01-01"),
    )
    assert rows(checks.long_inactive_unsigned(df, AS_OF), "client_id", "days_inactive") == [(2, 60)]


def test_plans(odd):
    assert rows(checks.plan_changes(odd), "client_id", "unique_plans", "all_plans") == [
        (7, 2, "Basic,Pro"),
        (8, 2, "Pro,Unknown"),
    ]
    row = checks.plan_changes(odd).where("client_id = 7").first()
    assert (row.first_event, row.last_event) == days("2023-01-01 20:00:00", "2023-01-05")


def test_docs_events(odd):
    assert rows(checks.docs_events(odd), "client_id") == [(3,), (6,)]


def test_union_is_the_sum_of_its_parts(odd, staged):
    for df in (odd, staged.drop("event_rank")):
        union = checks.inconsistencies(df, AS_OF)
        assert union.schema.names == FINDINGS_SCHEMA.names
        assert [t for _, t in union.dtypes] == [f.dataType.simpleString() for f in FINDINGS_SCHEMA]
        parts = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True),
            [check(df) for check in SINGLE_CHECKS.values()],
        )
        assert rows(union) == rows(
            parts.withColumns(
                {
                    c: F.lit(None).cast(FINDINGS_SCHEMA[c].dataType)
                    for c in FINDINGS_SCHEMA.names
                    if c not in parts.columns
                }
            ),
            *FINDINGS_SCHEMA.names,
        )


def test_every_type_is_found(odd):
    found = dict(rows(checks.inconsistency_counts(checks.inconsistencies(odd, AS_OF))))
    assert set(found) == set(checks.FINDING_TYPES)


def test_empty_input_keeps_schemas(odd):
    none = odd.limit(0)
    findings = checks.inconsistencies(none, AS_OF)
    assert findings.count() == 0
    assert findings.schema.names == FINDINGS_SCHEMA.names
    for name, check in SINGLE_CHECKS.items():
        empty = check(none)
        assert empty.count() == 0, name
        assert empty.schema == check(odd).schema, name
    assert checks.event_distribution(none).count() == 0
    assert checks.client_event_details(none, findings).count() == 0
    assert [r.cases for r in reports.scenario_summary(findings).collect()] == [0] * 5
    assert reports.scenario_insights(findings, checks.event_numbers(none)).first()[:5] == (0,) * 5
    assert reports.problem_events(findings).count() == 0


def test_distribution_with_null_type_and_lists(spark):
    df = events(
        spark,
        dict(client_id=1, event_type=None, event_date="2023-01-01", region=None),
        dict(client_id=None, event_type="applied", event_date="2023-01-01", sales_rep_id=None),
        dict(client_id=1, event_type="applied", event_date="2023-01-02", sales_rep_id=10),
        dict(client_id=1, event_type="applied", event_date="2023-01-02", sales_rep_id=11),
    )
    assert rows(
        checks.event_distribution(df),
        "event_type", "event_count", "unique_clients", "avg_sales_rep_id", "regions_involved",
    ) == [("applied", 3, 1, 10.5, "US"), (None, 1, 1, 57.0, None)]


def test_details_skip_unknown_clients(odd, spark):
    findings = spark.createDataFrame(
        [(6, "a"), (6, "b"), (6, "b"), (None, "a")], "client_id long, inconsistency_type string"
    )
    assert rows(checks.client_event_details(odd, findings), "client_id") == [(6,)] * 3


def test_severities(odd):
    findings = checks.inconsistencies(odd, AS_OF)
    assert dict(rows(reports.severity_counts(findings)))["High"] == 3
