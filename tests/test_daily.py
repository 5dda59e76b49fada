"""Reports from daily partials equal those from the events of the same days."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from fixtures import events, rows
from pyspark.sql import functions as F

from clienttrail import plans
from clienttrail.operators import checks, daily, funnel, staging
from clienttrail.plans import jobs
from clienttrail.schema import DAILY_NUMBERS_SCHEMA, DISTRIBUTION_SCHEMA, STAGED_SCHEMA
from clienttrail.sources import read_feature, write_table

RANGES = [
    (None, None),
    (date(2023, 1, 2), None),
    (None, date(2023, 1, 2)),
    (date(2023, 1, 2), date(2023, 1, 3)),
    (date(2024, 1, 1), date(2024, 1, 2)),
]


@pytest.fixture(scope="module")
def days(spark):
    return events(
        spark,
        dict(client_id=1, event_type="applied", event_date="2023-01-01 23:59:59"),
        dict(client_id=1, event_type="applied", event_date="2023-01-02 00:00:00", plan=None),
        dict(client_id=1, event_type="signed", event_date="2023-01-02 12:00:00", sales_rep_id=None),
        dict(client_id=1, event_type="signed", event_date="2023-01-02 12:00:00", sales_rep_id=None),
        dict(client_id=None, event_type="applied", event_date="2023-01-02", sales_rep_id=10),
        dict(client_id=2, event_type="applied", event_date="2023-01-03 23:59:59.999999", region="EU"),
        dict(client_id=2, event_type=None, event_date="2023-01-03", region=None),
        dict(client_id=2, event_type="churned", event_date="2023-01-04 08:00:00", plan="Free"),
        dict(client_id=2, event_type="signed", event_date="2023-01-05", plan="Basic"),
    )


def of_range(df, first, last):
    day = F.col("event_date").cast("date")
    if first:
        df = df.where(day >= F.lit(first))
    return df.where(day <= F.lit(last)) if last else df


@pytest.mark.parametrize("first, last", RANGES)
def test_merged_parts_equal_the_direct_reports(days, first, last):
    numbers = daily.between_days(daily.daily_numbers(days), first, last)
    values = daily.between_days(daily.daily_values(days), first, last)
    direct = of_range(days, first, last)
    assert rows(daily.merged_distribution(numbers, values)) == rows(checks.event_distribution(direct))
    assert rows(daily.merged_funnel(numbers)) == rows(funnel.client_funnel(direct))


def test_one_row_for_each_day_type_and_client(days):
    numbers = daily.daily_numbers(days.unionAll(days))
    got = rows(numbers.where("event_type = 'signed' and client_id = 1"), "event_day", "n", "rep_sum", "rep_n")
    assert got == [(date(2023, 1, 2), 4, None, 0)]
    assert daily.daily_numbers(days.limit(0)).count() == 0


def test_jobs_replace_days_and_read_only_the_asked_ones(spark, days, tmp_path):
    out, staged_path = str(tmp_path), str(tmp_path / "staged")
    staged = staging.stage_events(days)
    write_table(staged.select(*STAGED_SCHEMA.names), staged_path)
    numbers, values = plans.run_daily_parts(spark, staged_path, out)
    assert len(list(Path(numbers).glob("event_day=*"))) == 5

    # The third of January comes again with one event more; the other days stay.
    late = events(spark, dict(client_id=3, event_type="applied", event_date="2023-01-03 10:00:00"))
    again = days.unionByName(late)
    write_table(staging.stage_events(again).select(*STAGED_SCHEMA.names), str(tmp_path / "again"))
    third = date(2023, 1, 3)
    plans.run_daily_parts(spark, str(tmp_path / "again"), out, third, third)
    assert len(list(Path(numbers).glob("event_day=*"))) == 5

    for first, last in RANGES:
        path, stats = plans.run_daily_report(spark, out, f"{out}/report", first, last)
        direct = of_range(staging.stage_events(again), first, last)
        assert rows(read_feature(spark, path, DISTRIBUTION_SCHEMA)) == rows(checks.event_distribution(direct))
        durations = funnel.stage_durations(funnel.client_funnel(direct))
        assert rows(spark.read.parquet(stats)) == rows(funnel.stage_duration_stats(durations))

    parts = read_feature(spark, numbers, DAILY_NUMBERS_SCHEMA)
    plan = daily.between_days(parts, third, third)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan
    assert jobs.DAILY_NUMBERS in numbers and jobs.DAILY_VALUES in values
