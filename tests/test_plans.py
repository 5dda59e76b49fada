"""Shapes of the plans: few shuffles, narrow scans, nothing outside the JVM."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from clienttrail.operators import checks, churn, funnel, ranking
from clienttrail.sources import read_staged, write_table

SF_DIR = "/root/testdata/sf0.001"
AS_OF = "2025-08-08 08:02:47.230"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|single|Single)", plan(df)))


def read_columns(df) -> list[set[str]]:
    return [
        set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan(df))
    ]


@pytest.fixture(scope="module")
def table(spark, staged, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "staged")
    return read_staged(spark, write_table(staged, path))


def test_funnel_is_one_shuffle_of_three_columns(table):
    clients = funnel.client_funnel(table)
    assert shuffles(clients) == 1
    assert read_columns(clients) == [{"client_id", "event_type", "event_date"}]
    assert "HashAggregate" in plan(clients) and "SortAggregate" not in plan(clients)
    assert shuffles(funnel.funnel_metrics(clients)) == 2


def test_churn_needs_no_join_and_no_rank(table):
    clients = churn.client_churn(table, AS_OF)
    assert "Join" not in plan(clients)
    assert shuffles(clients) == 2
    assert read_columns(clients) == [{"client_id", "event_type", "event_date"}]


def test_unknown_values_are_narrow(table):
    assert shuffles(checks.unknown_values(table)) == 0


def test_all_client_checks_share_one_aggregation(table):
    findings = checks.inconsistencies(table, AS_OF)
    assert plan(findings).count("FileScan") == 2
    # Events go by client and plan; what is left of them then by client.
    assert shuffles(findings) == 2
    by = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan(findings))
    assert [re.sub(r"#\d+L?", "", keys) for keys in by] == ["client_id", "client_id, plan"]


def test_rank_of_ordinary_groups_is_one_shuffle(table):
    ranked = ranking.with_event_rank(table.drop("event_rank"))
    assert shuffles(ranked) == 1
    assert "Join" not in plan(ranked)


def test_unread_rank_costs_nothing(table):
    ranked = ranking.with_event_rank(table.drop("event_rank"))
    assert "Window" not in plan(funnel.client_funnel(ranked))


def test_sample_keeps_only_the_first_rows(table):
    from clienttrail.operators import reports

    assert "TakeOrderedAndProject" in plan(reports.affected_sample(table))


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(entry.own_queries()))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert operator not in text


# Queries whose rows show a region, or findings that may come from one: scans of the lookup table.
REGION_READERS = {
    "stage_cast": 1,
    "stage_unreadable": 0,
    "stage_date_order": 0,
    "stage_fill": 1,
    "staged_events": 1,
    "risk_by_region": 1,
    "chk_unknown_values": 1,
    "chk_unknown_values_strict": 1,
    "docs_events": 1,
    "event_distribution": 1,
    "daily_distribution": 1,
    "inconsistencies": 1,
    "inconsistency_counts": 1,
    "client_event_details": 2,
    "unknown_reason_counts": 1,
    "scenario_summary": 1,
    "scenario_insights": 1,
    "problem_events": 1,
    "question_counts": 1,
    "affected_monthly": 1,
    "affected_sample": 1,
}


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(entry.own_queries()))
def test_lookup_is_joined_only_for_regions(spark, name):
    text = plan(entry.own_queries()[name](spark, SF_DIR))
    scans = len(re.findall(r"FileScan[^\n]*customer\.parquet", text))
    assert scans == REGION_READERS.get(name, 0)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_asked_findings_read_little(spark):
    spread = plan(entry.own_queries()["application_spread"](spark, SF_DIR))
    assert len(re.findall(r"FileScan[^\n]*events\.parquet", spread)) == 1
    reasons = plan(entry.own_queries()["unknown_reason_counts"](spark, SF_DIR))
    assert len(re.findall(r"FileScan[^\n]*events\.parquet", reasons)) == 1
    assert "client_id" not in "".join(re.findall(r"HashAggregate\(keys=\[[^\]]*\]", reasons))


def test_large_groups_join_by_hash_and_are_read_once_more(table):
    events = table.drop("event_rank")
    ranked = ranking.with_event_rank(events, hot_rows=3, slice_rows=2)
    text = plan(ranked)
    assert "NestedLoop" not in text and "Cartesian" not in text
    ranked.collect()
    final = plan(ranked).split("Initial Plan")[0]
    # Ordinary rows, and the rows of large groups once for all three uses.
    scans = [line for line in final.splitlines() if "FileScan" in line]
    assert len(scans) <= 2


def test_report_reads_the_files_of_its_type(spark, table, tmp_path):
    from clienttrail.operators import reports
    from clienttrail.schema import FINDINGS_SCHEMA
    from clienttrail.sources import read_feature

    findings = checks.inconsistencies(table, AS_OF)
    path = write_table(findings, str(tmp_path / "findings"), partition_by=["inconsistency_type"])
    written = read_feature(spark, path, FINDINGS_SCHEMA)
    assert written.columns == FINDINGS_SCHEMA.names
    assert sorted(map(repr, written.collect())) == sorted(map(repr, findings.collect()))
    counts = reports.unknown_reason_counts(written)
    filters = re.findall(r"PartitionFilters: \[(.*?)\], ", plan(counts))
    assert len(filters) == 1 and f"= {checks.UNKNOWN_VALUES}" in filters[0]
    read = written.where(reports._is(checks.UNKNOWN_VALUES)).selectExpr("input_file_name() AS f").distinct()
    assert {r.f.rsplit("/", 2)[1] for r in read.collect()} == {f"inconsistency_type={checks.UNKNOWN_VALUES}"}


@pytest.mark.parametrize("hot_rows", [10**9, 3])
def test_bucketed_clients_need_no_shuffle(spark, table, tmp_path, hot_rows):
    from clienttrail.sources import per_client, read_client_buckets, write_client_buckets

    def details(events):
        return checks.client_event_details(events, checks.inconsistencies(events, AS_OF))

    name = f"staged_by_client_{hot_rows}"
    path = str(tmp_path / "buckets")
    tables = write_client_buckets(table, path, name, 4, hot_rows)
    assert (tables.large is None) == (hot_rows > 100)
    for operator in (
        funnel.client_funnel,
        lambda e: churn.client_churn(e, AS_OF),
        lambda e: checks.inconsistencies(e, AS_OF),
        details,
    ):
        result = per_client(tables, operator)
        assert sorted(map(repr, result.collect())) == sorted(map(repr, operator(table).collect()))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            text = plan(operator(tables.clients))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        if operator is not details:
            assert "Exchange" not in text
        # The union with findings of records leaves their ids, no events, to be dealt by client.
        assert len(re.findall("Exchange hashpartitioning", text)) <= (operator is details) * 2
    if tables.large is not None:
        counts = table.groupBy("client_id").count().where(f"count > {hot_rows}").count()
        assert tables.large.select("client_id").distinct().count() == counts
    spark.sql(f"DROP TABLE {name}")
    again = read_client_buckets(spark, path, name, 4)
    assert again.clients.count() + (again.large.count() if again.large else 0) == table.count()
    assert "Exchange" not in plan(funnel.client_funnel(again.clients))
