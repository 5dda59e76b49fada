from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from fixtures import day, days, events, rows
from pyspark.sql import functions as F
from test_ranking import skewed

from clienttrail.operators import churn
from clienttrail.operators.staging import with_event_rank

AS_OF = "2023-03-02 12:00:00"


def test_types_sharing_the_last_date_give_a_row_each(spark):
    df = events(
        spark,
        (1, "applied", "2023-01-01"),
        (1, "signed", "2023-01-02"),
        (1, "churned", "2023-01-02"),
        (2, "applied", "2023-01-01"),
        (2, "applied", "2023-01-02"),
        (None, "applied", "2023-01-01"),
    )
    assert rows(churn.churn_last_type(df), "client_id", "last_event_type") == [
        (1, "churned"),
        (1, "signed"),
        (2, None),
        (None, None),
    ]
    assert rows(churn.churn_last_type(df, dedup=True), "client_id", "last_event_type") == [
        (1, "churned"),
        (2, "applied"),
        (None, "applied"),
    ]


def test_last_type_equals_the_join_on_rank(spark):
    """Against the definition: left join to first-ranked events on client and last date."""
    df = skewed(spark, 400, seed=3)
    staged = with_event_rank(df).collect()
    by_client = defaultdict(list)
    for r in staged:
        by_client[r.client_id].append(r)
    expected = []
    for client, found in by_client.items():
        last = max(r.event_date for r in found)
        types = [r.event_type for r in found if r.event_rank == 1 and r.event_date == last]
        if client is None or not types:
            types = [None]
        expected += [(client, last, t) for t in types]
    actual = rows(churn.churn_last_type(df), "client_id", "last_event_date", "last_event_type")
    assert actual == sorted(expected, key=repr)


@pytest.mark.parametrize(
    "as_of",
    [
        AS_OF,
        datetime(2023, 3, 2, 12),
        datetime(2023, 3, 2, 14, tzinfo=timezone(timedelta(hours=2))),
    ],
)
def test_days_and_flag(spark, as_of):
    df = events(
        spark, (1, "applied", "2023-03-01"), (1, "signed", "2023-03-02"), (2, "churned", "2023-03-02")
    )
    assert rows(
        churn.client_churn(df, as_of),
        "client_id", "is_churned", "days_since_last_event", "days_since_signed",
    ) == [(1, 0, 0.5, 0.5), (2, 1, 0.5, None)]


def test_risk_limits(spark):
    df = spark.createDataFrame(
        [(30.0, 0), (30.5, 0), (60.0, 0), (60.5, 0), (90.0, 1), (None, 0), (None, 1)],
        "days_since_last_event double, is_churned int",
    )
    assert [r.risk_category for r in churn.client_risk(df).collect()] == [
        "Low Risk",
        "Medium Risk",
        "Medium Risk",
        "High Risk",
        "Already Churned",
        "Unknown",
        "Already Churned",
    ]
    no_flag = churn.client_risk(df.drop("is_churned"))
    assert [r.risk_category for r in no_flag.collect()][4:] == ["High Risk", "Unknown", "Unknown"]


def test_client_table_order(spark):
    when = day("2023-01-01")
    df = spark.createDataFrame(
        [
            (1, *[when] * 4, "signed", 0, 10.9, 10.2),
            (2, *[when] * 4, "signed", 0, 70.0, 1.0),
            (3, None, None, None, None, None, 0, None, None),
            (4, *[when] * 4, "churned", 1, 5.0, None),
            (5, *[when] * 4, "signed", 0, 80.0, 1.0),
            (6, *[when] * 4, "signed", 0, 45.0, 1.0),
        ],
        "client_id long, applied_date timestamp_ntz, signed_date timestamp_ntz, "
        "last_event_date timestamp_ntz, churned_date timestamp_ntz, last_event_type string, "
        "is_churned int, days_since_last_event double, days_since_signed double",
    )
    table = churn.churn_client_table(churn.client_risk(df)).collect()
    assert [r.client_id for r in table] == ["5", "2", "6", "1", "4", "3"]
    assert table[3][1:7] == ("2023-01-01",) * 4 + ("10", "10")
    assert table[5][1:7] == ("-",) * 6


def test_histogram(spark):
    values = [0.0, 0.5, 1.0, 2.0, 9.999, 10.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert rows(churn.histogram(df, "v", 10)) == [
        (0, 0.0, 1.0, 2),
        (1, 1.0, 2.0, 1),
        (2, 2.0, 3.0, 1),
        *[(i, float(i), float(i + 1), 0) for i in range(3, 9)],
        (9, 9.0, 10.0, 2),
    ]
    equal = rows(churn.histogram(df.where("v = 2"), "v", 10))
    assert equal == [(i, 2.0, 2.0, int(i == 0)) for i in range(10)]
    assert churn.histogram(df.where("v IS NULL"), "v", 10).count() == 0


def test_empty_input(spark):
    none = events(spark, (1, "applied", "2023-01-01")).limit(0)
    risk = churn.client_risk(churn.client_churn(none, AS_OF))
    summary = churn.churn_summary(risk)
    assert rows(summary) == [(0,) * 8 + (0.0, None, None, 0.0)]
    assert rows(churn.churn_insights(summary)) == [(0, 0, 0, 0.0, 0.0, 0.0, 0.0)]
    assert churn.idle_histogram(risk).count() == 0
    assert churn.risk_by_region(risk, churn.latest_region(none)).count() == 0


def test_region_of_the_latest_record(spark):
    df = events(
        spark,
        dict(client_id=1, event_type="applied", event_date="2023-01-02", region="US"),
        dict(client_id=1, event_type="signed", event_date="2023-01-02", region="CA"),
        dict(client_id=1, event_type="applied", event_date="2023-01-01", region="UK"),
        dict(client_id=2, event_type="applied", event_date="2023-01-01", region="UK"),
        dict(client_id=2, event_type="applied", event_date="2023-01-02", region=None),
    )
    regions = churn.latest_region(df)
    assert rows(regions) == [(1, "CA"), (2, None)]
    risk = churn.client_risk(churn.client_churn(df, AS_OF))
    table = churn.risk_by_region(risk, regions).collect()
    assert [(r.region, r.medium_risk) for r in table] == [("CA", 1)]
    assert churn.churn_last_events(df).where(F.col("client_id") == 1).first()[1:3] == days(
        "2023-01-02", "2023-01-02"
    )
