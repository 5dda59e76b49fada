"""The jobs write every table, as CSV and as Parquet, with the same content as the operators."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from fixtures import AS_OF, rows

from clienttrail import plans
from clienttrail.operators import checks, churn, funnel
from clienttrail.plans import jobs
from clienttrail.schema import CHURN_SCHEMA, DETAILS_SCHEMA, FINDINGS_SCHEMA, FUNNEL_SCHEMA
from clienttrail.sources import (
    preview,
    read_feature,
    read_raw_csv,
    read_staged,
    register_tables,
    write_table,
)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_all_layers(spark, raw_path, staged, tmp_path, fmt):
    out = str(tmp_path)
    staged_path = plans.run_staging(spark, raw_path, out, fmt)
    written = read_staged(spark, staged_path, fmt)
    assert rows(written) == rows(staged)

    funnel_path, metrics_path = plans.run_funnel(spark, staged_path, out, fmt)
    clients = read_feature(spark, funnel_path, FUNNEL_SCHEMA, fmt)
    assert rows(clients) == rows(funnel.client_funnel(staged))
    churn_path = plans.run_churn(spark, staged_path, out, AS_OF, fmt)
    assert rows(read_feature(spark, churn_path, CHURN_SCHEMA, fmt)) == rows(
        churn.client_churn(staged, AS_OF)
    )
    findings_path, details_path, _ = plans.run_inconsistencies(
        spark, staged_path, out, AS_OF, fmt, ordered=True
    )
    findings = read_feature(spark, findings_path, FINDINGS_SCHEMA, fmt)
    assert rows(findings) == rows(checks.inconsistencies(staged, AS_OF))
    details = read_feature(spark, details_path, DETAILS_SCHEMA, fmt)
    assert rows(details) == rows(checks.client_event_details(staged, findings))

    report = f"{out}/report"
    tables = {
        **plans.run_funnel_report(spark, out, report, fmt),
        **plans.run_churn_report(spark, out, staged_path, report, fmt),
        **plans.run_inconsistencies_report(spark, out, report, fmt),
    }
    for name, path in tables.items():
        assert spark.read.format(fmt).option("header", True).load(path).count() > 0, name
    assert metrics_path.endswith(jobs.METRICS)


def test_csv_text(spark, raw_path, tmp_path):
    path = plans.run_staging(spark, raw_path, str(tmp_path), "csv")
    lines = sorted(
        line
        for part in (tmp_path / jobs.STAGED).glob("*.csv")
        for line in part.read_text().splitlines()
    )
    assert "8,1003,applied,2023-01-08 00:00:00,Unknown,CA,Paid Ads,-1,web_api,1" in lines
    assert (
        "record_id,client_id,event_type,event_date,plan,region,marketing_channel,"
        "sales_rep_id,source_system,event_rank"
    ) in lines
    assert preview(read_staged(spark, path, "csv")).count() == 5


def test_other_dates_and_torn_records(spark, raw_path, staged, tmp_path):
    """Files with US dates stage in full; a line break in quotes is read whole or reported."""
    lines = Path(raw_path).read_text().splitlines()
    header = lines[0].split(",")
    at = header.index("event_date")
    swapped = [lines[0]]
    for line in lines[1:]:
        fields = line.split(",")
        year, month, date = fields[at].split("-")
        fields[at] = f"{month}/{date}/{year}"
        swapped.append(",".join(fields))
    path = tmp_path / "us.csv"
    path.write_text("\n".join(swapped) + "\n")
    assert rows(read_staged(spark, plans.run_staging(spark, str(path), str(tmp_path / "a")))) == rows(staged)
    assert spark.read.parquet(str(tmp_path / "a" / jobs.UNREADABLE)).count() == 0

    record = dict(zip(header, lines[1].split(","))) | {"record_id": "99", "plan": '"two\nlines"'}
    path.write_text("\n".join([*swapped, ",".join(record[c] for c in header)]) + "\n")
    torn = plans.run_staging(spark, str(path), str(tmp_path / "b"))
    assert rows(read_staged(spark, torn)) == rows(staged)
    lost = spark.read.parquet(str(tmp_path / "b" / jobs.UNREADABLE)).collect()
    assert {r.column_name for r in lost} == {"torn_record"} and len(lost) == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, str(path)).collect()
    whole = read_staged(spark, plans.run_staging(spark, str(path), str(tmp_path / "c"), multiline=True))
    assert whole.where("record_id = 99").first().plan == "Two\nLines"


def _with_dates(raw_path, path, order):
    """The raw file with its dates in figures, in the given order of year (0), month (1) and day (2)."""
    lines = Path(raw_path).read_text().splitlines()
    at = lines[0].split(",").index("event_date")
    out = [lines[0]]
    for line in lines[1:]:
        fields = line.split(",")
        parts = fields[at].split("-")
        fields[at] = "/".join(parts[i] for i in order)
        out.append(",".join(fields))
    path.write_text("\n".join(out) + "\n")
    return str(path)


def test_day_first_files_stage_right(spark, raw_path, staged, tmp_path):
    path = _with_dates(raw_path, tmp_path / "day.csv", (2, 1, 0))
    written = plans.run_staging(spark, path, str(tmp_path / "out"))
    assert rows(read_staged(spark, written)) == rows(staged)
    assert spark.read.parquet(str(tmp_path / "out" / jobs.UNREADABLE)).count() == 0
    order = spark.read.parquet(str(tmp_path / "out" / jobs.DATE_ORDER)).first()
    assert order["date_order"] == "day" and order["day_first"] > 0 == order["month_first"]
    given = plans.run_staging(spark, path, str(tmp_path / "given"), date_formats=["M/d/yyyy"])
    assert read_staged(spark, given).count() < staged.count()


def test_raw_files_are_parsed_once(spark, raw_path, staged, tmp_path):
    """Nothing after the first step needs the CSV, and large groups are those counted there."""
    path = tmp_path / "events.csv"
    path.write_text(Path(raw_path).read_text())
    out = str(tmp_path / "out")
    plans.run_parse(spark, str(path), out, hot_rows=2)
    path.unlink()
    assert spark.read.parquet(f"{out}/{jobs.HOT_GROUPS}").count() == (
        staged.groupBy("client_id", "event_type").count().where("count > 2").count()
    )
    assert rows(read_staged(spark, plans.run_rank(spark, out))) == rows(staged)
    assert spark.read.parquet(f"{out}/{jobs.UNREADABLE}").count() == 0


def test_layers_from_buckets(spark, staged, tmp_path):
    from clienttrail.sources import write_client_buckets

    tables = write_client_buckets(staged, str(tmp_path / "buckets"), "layers_by_client", 4, hot_rows=3)
    assert tables.large is not None
    written = plans.run_client_layers(spark, tables, str(tmp_path / "out"), AS_OF)
    clients = read_feature(spark, written[jobs.FUNNEL], FUNNEL_SCHEMA)
    assert rows(clients) == rows(funnel.client_funnel(staged))
    findings = read_feature(spark, written[jobs.FINDINGS], FINDINGS_SCHEMA)
    wanted = checks.inconsistencies(staged, AS_OF)
    assert sorted(map(repr, rows(findings))) == sorted(map(repr, rows(wanted)))
    spark.sql("DROP TABLE layers_by_client")


def test_csv_keeps_every_value(spark, tmp_path):
    schema = "id long, at timestamp_ntz, text string"
    times = [datetime(2023, 1, 5), datetime(2023, 1, 5, 10, 0, 0, 123456), datetime(2023, 1, 5, 10, 0, 0, 500000), None]
    texts = ["a", 'say "hi", you', "x y", None]
    df = spark.createDataFrame(list(zip(range(4), times, texts)), schema)
    for fmt in ("csv", "parquet"):
        path = write_table(df, str(tmp_path / fmt), fmt)
        assert rows(read_feature(spark, path, df.schema, fmt)) == rows(df)


def test_registered_tables(spark, staged):
    register_tables({"f_staging_events": staged})
    assert spark.sql("SELECT count(*) FROM f_staging_events WHERE event_rank > 1").first()[0] == 5
