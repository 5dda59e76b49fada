"""One job per layer: read a table, apply operators, write tables.

Each job writes its main table first and derives the others from the written one, so large
intermediate results are computed once and a lost executor costs no recomputation of earlier steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clienttrail.operators import checks, churn, daily, funnel, reports, staging
from clienttrail.operators.ranking import GROUP, rank_events
from clienttrail.operators.skew import HOT_ROWS, hot_keys
from clienttrail.schema import (
    CHURN_SCHEMA,
    DAILY_NUMBERS_SCHEMA,
    DAILY_VALUES_SCHEMA,
    DETAILS_SCHEMA,
    DISTRIBUTION_SCHEMA,
    FINDINGS_SCHEMA,
    FUNNEL_SCHEMA,
    NULL_TOKENS,
)
from clienttrail.sources import (
    ClientTables,
    per_client,
    read_feature,
    read_raw_csv,
    read_staged,
    write_table,
)

UNREADABLE = "staging_unreadable_values"
PARSED = "staging_parsed_records"
HOT_GROUPS = "staging_hot_groups"
DATE_ORDER = "staging_date_order"
DAILY_NUMBERS = "daily_event_numbers"
DAILY_VALUES = "daily_event_values"
DURATION_STATS = "stage_duration_stats"
# Names of the feature tables.
STAGED = "f_staging_events"
FUNNEL = "f_funnel_data"
METRICS = "f_funnel_metrics"
CHURN = "f_churn_data"
FINDINGS = "f_inconsistencies"
DETAILS = "f_inconsistencies_client_details"
DISTRIBUTION = "f_event_distribution_analysis"


def run_staging(
    spark: SparkSession,
    raw_path: str | list[str],
    out_dir: str,
    fmt: str = "parquet",
    date_formats: Sequence[str] | None = None,
    null_tokens: Iterable[str] = NULL_TOKENS,
    multiline: bool = False,
) -> str:
    """Raw CSV -> staged event table, and beside it the table of values that could not be read."""
    run_parse(spark, raw_path, out_dir, date_formats, null_tokens, multiline)
    return run_rank(spark, out_dir, fmt)


def run_parse(
    spark: SparkSession,
    raw_path: str | list[str],
    out_dir: str,
    date_formats: Sequence[str] | None = None,
    null_tokens: Iterable[str] = NULL_TOKENS,
    multiline: bool = False,
    hot_rows: int = HOT_ROWS,
) -> str:
    """Raw CSV -> parsed records, and beside them how dates are written and which groups are large; Parquet.

    The CSV is read once. The order of day and month is counted over the whole column in the same pass; a
    column that mixes both orders is read month first and reported as `mixed`. Events are counted while they are written, and only if there are enough of them for
    a large group are the groups counted, from the two columns written.
    """
    source = read_raw_csv(spark, raw_path, null_tokens, multiline, keep_torn=True)
    raw = staging.normalise_columns(source)
    counts = [c.alias(name) for name, c in staging.date_order_counts(raw).items()]
    rows, dates = Observation(), Observation()
    parsed = staging.parse_events(raw.observe(dates, *counts), date_formats)
    path = f"{out_dir}/{PARSED}"
    write_table(parsed.observe(rows, F.count("event").alias("events")), path)

    order = spark.createDataFrame([dates.get], "day_first long, month_first long, ambiguous long")
    order = order.select("*", staging.date_order_of("day_first", "month_first").alias("date_order"))
    write_table(order.coalesce(1), f"{out_dir}/{DATE_ORDER}")
    events = staging.parsed_events(spark.read.schema(parsed.schema).parquet(path))
    hot = hot_keys(events, GROUP, hot_rows)
    if rows.get["events"] <= hot_rows:
        hot = spark.createDataFrame([], hot.schema)
    write_table(hot.coalesce(1), f"{out_dir}/{HOT_GROUPS}")
    return path


def run_rank(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> str:
    """Parsed records -> staged event table and unreadable values; the raw files are not needed any more.

    Dates in figures are read with the day first if all of the column that tell are written so.
    """
    parsed = spark.read.parquet(f"{out_dir}/{PARSED}")
    day_first = spark.read.parquet(f"{out_dir}/{DATE_ORDER}").first()["date_order"] == "day"
    losses = staging.parsed_losses(parsed, day_first)
    write_table(losses, f"{out_dir}/{UNREADABLE}", fmt)
    hot = spark.read.parquet(f"{out_dir}/{HOT_GROUPS}")
    events = staging.parsed_events(parsed, day_first)
    return write_table(rank_events(events, None if hot.isEmpty() else hot), f"{out_dir}/{STAGED}", fmt)


def run_funnel(
    spark: SparkSession, staged_path: str, out_dir: str, fmt: str = "parquet"
) -> tuple[str, str]:
    """Staged events -> first dates per client and the metrics row."""
    staged = read_staged(spark, staged_path, fmt)
    path = write_table(funnel.client_funnel(staged), f"{out_dir}/{FUNNEL}", fmt)
    written = read_feature(spark, path, FUNNEL_SCHEMA, fmt)
    return path, write_table(funnel.funnel_metrics(written), f"{out_dir}/{METRICS}", fmt)


def run_churn(
    spark: SparkSession,
    staged_path: str,
    out_dir: str,
    as_of: datetime | str,
    fmt: str = "parquet",
    dedup: bool = False,
) -> str:
    """Staged events -> recency and churn flag per client."""
    staged = read_staged(spark, staged_path, fmt)
    return write_table(churn.client_churn(staged, as_of, dedup), f"{out_dir}/{CHURN}", fmt)


def run_inconsistencies(
    spark: SparkSession,
    staged_path: str,
    out_dir: str,
    as_of: datetime | str,
    fmt: str = "parquet",
    ordered: bool = False,
) -> tuple[str, str, str]:
    """Staged events -> findings, events of affected clients and the event distribution.

    Findings are partitioned on disk by type, so that a report reads the types it shows. `ordered` sorts them
    as the report lists them, at the price of a range shuffle; they are then one table in that order.
    """
    staged = read_staged(spark, staged_path, fmt)
    found = checks.inconsistencies(staged, as_of)
    if ordered:
        path = write_table(checks.in_report_order(found), f"{out_dir}/{FINDINGS}", fmt)
    else:
        path = write_table(found, f"{out_dir}/{FINDINGS}", fmt, partition_by=["inconsistency_type"])
    findings = read_feature(spark, path, FINDINGS_SCHEMA, fmt)
    return (
        path,
        write_table(
            checks.client_event_details(staged, findings), f"{out_dir}/{DETAILS}", fmt
        ),
        write_table(checks.event_distribution(staged), f"{out_dir}/{DISTRIBUTION}", fmt),
    )


def run_daily_parts(
    spark: SparkSession,
    staged_path: str,
    out_dir: str,
    first_day: date | None = None,
    last_day: date | None = None,
    fmt: str = "parquet",
) -> tuple[str, str]:
    """Staged events of a range of days (both ends included) -> their daily partial aggregates, by day.

    Days of the range that have events are replaced, all other days stay as they were written. Rows are dealt by
    day, and adaptive execution splits a day with very many of them.
    """
    events = read_staged(spark, staged_path, fmt)
    if first_day is not None:
        events = events.where(F.col("event_date") >= F.lit(first_day).cast("timestamp_ntz"))
    if last_day is not None:
        end = F.lit(last_day + timedelta(days=1)).cast("timestamp_ntz")
        events = events.where(F.col("event_date") < end)
    parts = {DAILY_NUMBERS: daily.daily_numbers(events), DAILY_VALUES: daily.daily_values(events)}
    numbers, values = (
        write_table(
            part.hint("rebalance", "event_day"),
            f"{out_dir}/{name}",
            partition_by=["event_day"],
            only_present=True,
        )
        for name, part in parts.items()
    )
    return numbers, values


def run_daily_report(
    spark: SparkSession,
    parts_dir: str,
    out_dir: str,
    first_day: date | None = None,
    last_day: date | None = None,
    fmt: str = "parquet",
) -> tuple[str, str]:
    """Daily partials -> event distribution and stage durations of a range of days, without the events.

    Only the folders of these days are read.
    """
    numbers, values = (
        daily.between_days(read_feature(spark, f"{parts_dir}/{name}", schema), first_day, last_day)
        for name, schema in ((DAILY_NUMBERS, DAILY_NUMBERS_SCHEMA), (DAILY_VALUES, DAILY_VALUES_SCHEMA))
    )
    stats = funnel.stage_duration_stats(funnel.stage_durations(daily.merged_funnel(numbers)))
    return (
        write_table(daily.merged_distribution(numbers, values), f"{out_dir}/{DISTRIBUTION}", fmt),
        write_table(stats, f"{out_dir}/{DURATION_STATS}", fmt),
    )


def run_client_layers(
    spark: SparkSession, tables: ClientTables, out_dir: str, as_of: datetime | str, fmt: str = "parquet"
) -> dict[str, str]:
    """Funnel, churn, findings and the events of affected clients from tables bucketed by client.

    Clients in buckets need no shuffle; those with very many events are aggregated before theirs, as ever.
    """

    def details(events: DataFrame) -> DataFrame:
        return checks.client_event_details(events, checks.inconsistencies(events, as_of))

    layers = {
        FUNNEL: per_client(tables, funnel.client_funnel),
        CHURN: per_client(tables, lambda events: churn.client_churn(events, as_of)),
        FINDINGS: per_client(tables, lambda events: checks.inconsistencies(events, as_of)),
        DETAILS: per_client(tables, details),
    }
    return _write_all(layers, out_dir, fmt)


def _write_all(tables: dict[str, DataFrame], out_dir: str, fmt: str) -> dict[str, str]:
    return {name: write_table(df, f"{out_dir}/{name}", fmt) for name, df in tables.items()}


def run_funnel_report(
    spark: SparkSession, features_dir: str, out_dir: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Written funnel -> the tables of the funnel report."""
    clients = read_feature(spark, f"{features_dir}/{FUNNEL}", FUNNEL_SCHEMA, fmt)
    metrics = funnel.funnel_metrics(clients)
    path = f"{features_dir}/{METRICS}"
    metrics = read_feature(spark, path, metrics.schema, fmt)
    durations = funnel.stage_durations(clients)
    tables = {
        "funnel_overview": funnel.funnel_overview(metrics),
        "funnel_rates": funnel.funnel_rates(metrics),
        "funnel_summary": funnel.funnel_summary(metrics),
        "funnel_waterfall": funnel.funnel_waterfall(metrics),
        "funnel_insights": funnel.funnel_insights(metrics),
        "stage_durations": durations,
        "stage_duration_stats": funnel.stage_duration_stats(durations),
        "journey_types": funnel.journey_types(clients),
        "funnel_client_table": funnel.funnel_client_table(clients),
        "funnel_monthly": funnel.funnel_monthly(clients),
    }
    return _write_all(tables, out_dir, fmt)


def run_churn_report(
    spark: SparkSession, features_dir: str, staged_path: str, out_dir: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Written churn table (and staged events, for the regions) -> the churn report."""
    clients = read_feature(spark, f"{features_dir}/{CHURN}", CHURN_SCHEMA, fmt)
    staged = read_staged(spark, staged_path, fmt)
    risk = churn.client_risk(clients)
    summary = churn.churn_summary(risk)
    path = write_table(summary, f"{out_dir}/churn_summary", fmt)
    summary = read_feature(spark, path, summary.schema, fmt)
    tables = {
        "churn_summary_table": churn.churn_summary_table(summary),
        "churn_insights": churn.churn_insights(summary),
        "churned_vs_at_risk": churn.churned_vs_at_risk(summary),
        "risk_distribution": churn.risk_distribution(risk),
        "idle_histogram": churn.idle_histogram(risk),
        "signed_histogram": churn.signed_histogram(clients),
        "churn_client_table": churn.churn_client_table(risk),
        "last_event_monthly": churn.last_event_monthly(clients),
        "risk_by_region": churn.risk_by_region(risk, churn.latest_region(staged)),
    }
    return {"churn_summary": path} | _write_all(tables, out_dir, fmt)


def run_inconsistencies_report(
    spark: SparkSession, features_dir: str, out_dir: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Written findings, details and distribution -> the data-quality report."""
    findings = read_feature(spark, f"{features_dir}/{FINDINGS}", FINDINGS_SCHEMA, fmt)
    details = read_feature(spark, f"{features_dir}/{DETAILS}", DETAILS_SCHEMA, fmt)
    distribution = read_feature(
        spark, f"{features_dir}/{DISTRIBUTION}", DISTRIBUTION_SCHEMA, fmt
    )
    tables = {
        "inconsistency_counts": checks.inconsistency_counts(findings),
        "unknown_reason_counts": reports.unknown_reason_counts(findings),
        "violation_points": reports.violation_points(findings),
        "docs_pattern_counts": reports.docs_pattern_counts(findings),
        "application_spread": reports.application_spread(findings),
        "event_type_counts": reports.event_type_counts(distribution),
        "scenario_summary": reports.scenario_summary(findings),
        "scenario_insights": reports.scenario_insights(findings, distribution),
        "problem_events": reports.problem_events(findings),
        "question_counts": reports.question_counts(findings),
        "severity_counts": reports.severity_counts(findings),
        "affected_monthly": reports.affected_monthly(details),
        "affected_sample": reports.affected_sample(details),
    }
    return _write_all(tables, out_dir, fmt)
