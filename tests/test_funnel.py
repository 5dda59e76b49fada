from __future__ import annotations

import pytest
from fixtures import events, rows
from pyspark.sql import functions as F

from clienttrail.functions import elapsed_days, percent_text, whole_days
from clienttrail.operators import funnel


def test_empty_input(spark):
    none = events(spark, (1, "applied", "2023-01-01")).limit(0)
    clients = funnel.client_funnel(none)
    assert clients.count() == 0
    metrics = funnel.funnel_metrics(clients)
    assert rows(metrics) == [(0,) * 6 + (0.0,) * 5 + (0,)]
    assert funnel.stage_durations(clients).count() == 0
    assert funnel.stage_duration_stats(funnel.stage_durations(clients)).count() == 0
    assert funnel.journey_types(clients).count() == 0


def test_metrics_count_the_dates(spark):
    df = events(
        spark,
        (1, "applied", "2023-01-01"),
        (1, "churned", "2023-01-03"),
        (2, "churned", "2023-01-02"),
        (3, "signed", "2023-01-02"),
        (4, "other", "2023-01-02"),
    )
    clients = funnel.client_funnel(df)
    row = funnel.funnel_metrics(clients).first()
    assert row[:6] == (4, 1, 0, 0, 1, 2)
    assert row.churn_rate == 2.0
    assert row.active_clients == 0
    assert dict(rows(funnel.funnel_summary(funnel.funnel_metrics(clients))))[
        "Retention Rate: Signed → Active"
    ] == "-100.0%"


def test_elapsed_days_floor(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (TIMESTAMP_NTZ'2023-01-01 20:00:00', TIMESTAMP_NTZ'2023-01-02 06:00:00'),
        (TIMESTAMP_NTZ'2023-01-02 06:00:00', TIMESTAMP_NTZ'2023-01-01 20:00:00'),
        (TIMESTAMP_NTZ'2023-01-03 00:00:00', TIMESTAMP_NTZ'2023-01-01 12:00:00'),
        (TIMESTAMP_NTZ'2023-01-01 00:00:00.000001', TIMESTAMP_NTZ'2023-01-03 00:00:00')
        AS t(a, b)"""
    )
    assert [r[0] for r in df.select(whole_days("a", "b")).collect()] == [0, -1, -2, 1]


def test_elapsed_days_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "SELECT TIMESTAMP_NTZ'2023-03-11 12:00:00' a, TIMESTAMP_NTZ'2023-03-12 12:00:00' b"
        )
        assert df.select(elapsed_days("a", "b")).first()[0] == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("rate", [0.0625, 0.1875, 0.1435, 0.0005, 0.9995, 1.0, 0.0, -0.333, 12.34567])
def test_percent_text_is_pythons(spark, rate):
    df = spark.createDataFrame([(rate,)], "r double")
    assert df.select(percent_text(F.col("r"))).first()[0] == f"{rate:.1%}"


def test_all_journeys(spark):
    def client(n, *types):
        return [(n, t, "2023-01-01") for t in types]

    df = events(
        spark,
        *client(1, "applied", "rejected", "churned"),
        *client(2, "docs_submitted", "churned"),
        *client(3, "churned"),
        *client(4, "signed", "docs_submitted"),
        *client(5, "signed"),
        *client(6, "docs_submitted", "applied"),
        *client(7, "applied"),
        *client(8, "something"),
    )
    found = [r.journey_type.split(" (")[0] for r in funnel.journey_types(funnel.client_funnel(df)).collect()]
    assert sorted(found) == [
        "Active Client",
        "Active with Docs",
        "Applied Only",
        "Docs Submitted",
        "Full Journey",
        "Full Journey with Docs",
        "Other",
        "Rejected",
    ]


def test_monthly_counts_conversions_of_applicants_only(spark):
    df = events(
        spark,
        (1, "applied", "2023-01-31"),
        (1, "signed", "2023-02-01"),
        (2, "signed", "2023-02-01"),
        (3, "applied", "2023-03-01"),
    )
    assert rows(funnel.funnel_monthly(funnel.client_funnel(df))) == [
        ("2023-01", 1, 0),
        ("2023-02", 0, 1),
        ("2023-03", 1, 0),
    ]


def test_client_table_lists_missing_applications_last(spark):
    df = events(
        spark,
        (1, "signed", "2023-01-01"),
        (2, "applied", "2023-01-02 10:00:00"),
        (3, "applied", "2023-01-02 09:00:00"),
        (4, "applied", "2023-01-01"),
    )
    table = funnel.funnel_client_table(funnel.client_funnel(df)).collect()
    assert [r.client_id for r in table] == ["4", "2", "3", "1"]
