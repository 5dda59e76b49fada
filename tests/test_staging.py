from __future__ import annotations

from datetime import datetime

import pytest
from fixtures import day, rows
from pyspark.sql import functions as F

from clienttrail.functions import title_case
from clienttrail.operators import staging
from clienttrail.schema import RAW_COLUMNS
from clienttrail.sources import read_raw_csv

GOOD = dict(
    record_id="1",
    client_id="1001",
    event_type="applied",
    event_date="2023-01-05",
    plan="basic",
    region="US",
    marketing_channel="Email",
    sales_rep_id="57",
    source_system="web_api",
)


def text_rows(spark, *changes: dict):
    data = [tuple({**GOOD, **c}[n] for n in RAW_COLUMNS) for c in changes]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in RAW_COLUMNS))


def test_bad_values_become_null(spark):
    df = staging.cast_events(
        text_rows(
            spark,
            dict(event_date="not-a-date"),
            dict(client_id="abc"),
            dict(sales_rep_id="57.9"),
            dict(record_id="9007199254740993"),
            dict(record_id=" 12 ", sales_rep_id="1e2", event_date="2023-01-05 06:07:08.5"),
            dict(client_id=None, event_date=None, sales_rep_id="inf"),
        )
    )
    found = [tuple(r) for r in df.select("record_id", "client_id", "event_date", "sales_rep_id").collect()]
    when = day("2023-01-05")
    assert found == [
        (1, 1001, None, 57),
        (1, None, when, 57),
        (1, 1001, when, 57),
        (9007199254740993, 1001, when, 57),
        (12, 1001, datetime(2023, 1, 5, 6, 7, 8, 500000), 100),
        (1, None, None, None),
    ]


def test_typed_input_is_kept(spark):
    df = spark.createDataFrame(
        [(1, 2.7, datetime(2023, 1, 5))], "record_id int, client_id double, event_date date"
    )
    cast = staging.cast_events(df)
    assert dict(cast.dtypes) == {
        "record_id": "bigint",
        "client_id": "bigint",
        "event_date": "timestamp_ntz",
    }
    assert rows(cast) == [(1, None, day("2023-01-05"))]
    whole = staging.cast_events(df.selectExpr("2D AS client_id", "57.9D AS sales_rep_id"))
    assert rows(whole) == [(2, 57)]


def test_date_formats(spark):
    texts = {
        "01/31/2023": day("2023-01-31"),
        "1/5/2023 6:07": datetime(2023, 1, 5, 6, 7),
        "Jan 7, 2023": day("2023-01-07"),
        "2023-01-05": day("2023-01-05"),
        " 2023-01-05 06:07:08.123456 ": datetime(2023, 1, 5, 6, 7, 8, 123456),
        "2023-01-07T10:00:00+02:00": datetime(2023, 1, 7, 8),
        "2023-01-07 10:00:00-0530": datetime(2023, 1, 7, 15, 30),
        "2023-01-07T10:00:00.5Z": datetime(2023, 1, 7, 10, 0, 0, 500000),
        "2023": None,
        "31/01/2023": None,
        "": None,
    }
    df = text_rows(spark, *[dict(event_date=t) for t in texts])
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert [r.event_date for r in staging.cast_events(df).collect()] == [*texts.values()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    other = staging.cast_events(df, ["dd/MM/yyyy"]).collect()
    assert [r.event_date for r in other][9] == day("2023-01-31") and other[0].event_date is None


def test_numbers_are_plain(spark):
    texts = {"57d": None, "5f": None, "57.9": None, "57.0": 57, " 5e1 ": 50, "0x10": None, "1_0": None, "-3": -3}
    df = text_rows(spark, *[dict(client_id=t) for t in texts])
    assert [r.client_id for r in staging.cast_events(df).collect()] == [*texts.values()]


def test_unreadable_values_are_listed(spark):
    df = text_rows(
        spark, {}, dict(record_id="2", client_id="7.5", event_date="?"), dict(record_id="x", sales_rep_id="5.5")
    )
    assert sorted(rows(staging.unreadable_values(df))) == [
        ("2", "client_id", "7.5"),
        ("2", "event_date", "?"),
        ("x", "record_id", "x"),
    ]


def test_fill_missing(spark):
    df = text_rows(
        spark,
        dict(plan=None, region=None, marketing_channel=None, sales_rep_id=None, source_system=None),
    )
    filled = staging.fill_missing(staging.cast_events(df))
    assert rows(
        filled, "plan", "region", "marketing_channel", "sales_rep_id", "source_system"
    ) == [("Unknown", None, "unknown", -1, "unknown")]
    assert staging.fill_missing(df.select("plan", "region")).columns == ["plan", "region"]


@pytest.mark.parametrize(
    "text",
    ["basic", "PRO PLUS", "pro-plus", "they're", "a1b2 c3", "  two  spaces", "", "x_y z", "é-été", "1st tier"],
)
def test_title_case_is_pythons(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(title_case(F.col("t"))).first()[0] == text.title()


def test_undated_rows_are_dropped_and_null_keys_kept(spark):
    df = text_rows(
        spark,
        dict(event_date="?"),
        dict(record_id="2", client_id="abc"),
        dict(record_id="3", client_id=None, event_date="2023-01-04"),
        dict(record_id="4", event_type=None),
        dict(record_id="5", event_type=None, event_date="2023-01-04"),
    )
    found = rows(staging.stage_events(df), "record_id", "client_id", "event_type", "event_rank")
    assert found == [
        (2, None, "applied", 2),
        (3, None, "applied", 1),
        (4, 1001, None, 2),
        (5, 1001, None, 1),
    ]


def test_columns_are_normalised_and_required(spark):
    df = text_rows(spark, {}).toDF(*[c.replace("_", " ").title() for c in RAW_COLUMNS])
    assert staging.normalise_columns(df).columns == list(RAW_COLUMNS)
    with pytest.raises(ValueError, match="plan, region"):
        staging.stage_events(text_rows(spark, {}).drop("plan", "region"))


def test_csv_source(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "client_id,record_id,event_type,event_date,plan,region,marketing_channel,"
        "sales_rep_id,source_system,extra\n"
        '7,1,applied,2023-01-05,"say ""hi"", you",NA,,null,"",x\n'
    )
    df = read_raw_csv(spark, str(path))
    assert df.columns[0] == "client_id" and df.columns[-1] == "extra"
    row = df.first()
    assert row.plan == 'say "hi", you'
    assert (row.region, row.marketing_channel, row.sales_rep_id, row.source_system) == (None,) * 4
    kept = read_raw_csv(spark, str(path), null_tokens=()).first()
    assert (kept.region, kept.sales_rep_id) == ("NA", "null")
    staged = staging.stage_events(df)
    assert rows(staged, "client_id", "record_id", "sales_rep_id") == [(7, 1, -1)]


def test_empty_input(spark):
    staged = staging.stage_events(text_rows(spark, {}).limit(0))
    assert staged.count() == 0
    assert dict(staged.dtypes)["event_rank"] == "bigint"


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("client_id,record_id\n1,2\n")
    (tmp_path / "b.csv").write_text("record_id,client_id\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path)).collect()


def test_one_pass_gives_events_and_losses(spark):
    df = text_rows(
        spark, {}, dict(record_id="2", client_id="7.5", event_date="?", plan=None), dict(record_id="x", sales_rep_id="5.5"),
        dict(event_date="Jan 7, 2023"), dict(event_date="2023-01-07T10:00:00+02:00"), dict(event_date="1/5/2023"),
    ).withColumn("torn_record", F.when(F.col("sales_rep_id") == "5.5", F.lit("x,5.5")))
    parsed = staging.parse_events(df)
    assert parsed.count() == df.count()
    assert sorted(map(repr, rows(staging.parsed_events(parsed)))) == sorted(map(repr, rows(staging.clean_events(df))))
    assert staging.parsed_events(parsed).dtypes == staging.clean_events(df).dtypes
    assert sorted(rows(staging.parsed_losses(parsed))) == sorted(rows(staging.unreadable_values(df)))


@pytest.mark.parametrize(
    ("dates", "order"),
    [
        (["13/5/2023", "1/2/2023", "2023-01-05", "?"], "day"),
        (["5/13/2023 6:07", "1/2/2023"], "month"),
        (["5/13/2023", "13/5/2023"], "mixed"),
        (["1/2/2023", "3/3/2023", None, "13/13/2023"], None),
        ([], None),
    ],
)
def test_date_order(spark, dates, order):
    df = text_rows(spark, *[dict(event_date=d) for d in dates]) if dates else text_rows(spark, {}).limit(0)
    assert staging.date_order(df).collect()[0]["date_order"] == order
