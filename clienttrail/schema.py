"""Fixed values and schemas of the event tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types in funnel order.
APPLIED = "applied"
DOCS_SUBMITTED = "docs_submitted"
REJECTED = "rejected"
SIGNED = "signed"
CHURNED = "churned"

# Columns of the raw and of the staged table, in output order.
RAW_COLUMNS = (
    "record_id",
    "client_id",
    "event_type",
    "event_date",
    "plan",
    "region",
    "marketing_channel",
    "sales_rep_id",
    "source_system",
)
NUMERIC_COLUMNS = ("record_id", "client_id", "sales_rep_id")

# Column in which the CSV source keeps a record with too few or too many fields.
TORN_RECORD = "torn_record"

# Defaults for missing fields (the plan is title-cased afterwards).
UNKNOWN = "unknown"
UNKNOWN_PLAN = "Unknown"
NO_SALES_REP = -1

# Text that the CSV source reads as missing (the usual pandas list).
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# event_rank is a bigint: one client may have more than 2^31 events of a type.
STAGED_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("client_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_date", T.TimestampNTZType()),
        T.StructField("plan", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("marketing_channel", T.StringType()),
        T.StructField("sales_rep_id", T.LongType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("event_rank", T.LongType()),
    ]
)

DETAILS_SCHEMA = T.StructType(
    [
        STAGED_SCHEMA[c]
        for c in (
            "client_id",
            "record_id",
            "event_type",
            "event_date",
            "plan",
            "region",
            "marketing_channel",
            "sales_rep_id",
            "source_system",
            "event_rank",
        )
    ]
)

DISTRIBUTION_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("unique_clients", T.LongType()),
        T.StructField("earliest_date", T.TimestampNTZType()),
        T.StructField("latest_date", T.TimestampNTZType()),
        T.StructField("avg_sales_rep_id", T.DoubleType()),
        T.StructField("plans_involved", T.StringType()),
        T.StructField("regions_involved", T.StringType()),
    ]
)

#: Daily partial aggregates, partitioned by event_day.
DAILY_NUMBERS_SCHEMA = T.StructType(
    [
        T.StructField("event_day", T.DateType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("client_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("first", T.TimestampNTZType()),
        T.StructField("last", T.TimestampNTZType()),
        T.StructField("rep_sum", T.LongType()),
        T.StructField("rep_n", T.LongType()),
    ]
)

DAILY_VALUES_SCHEMA = T.StructType(
    [T.StructField("event_day", T.DateType())]
    + [T.StructField(name, T.StringType()) for name in ("event_type", "plan", "region")]
)

FUNNEL_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("applied_date", T.TimestampNTZType()),
        T.StructField("docs_submitted_date", T.TimestampNTZType()),
        T.StructField("rejected_date", T.TimestampNTZType()),
        T.StructField("signed_date", T.TimestampNTZType()),
        T.StructField("churned_date", T.TimestampNTZType()),
    ]
)

CHURN_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("last_event_date", T.TimestampNTZType()),
        T.StructField("applied_date", T.TimestampNTZType()),
        T.StructField("signed_date", T.TimestampNTZType()),
        T.StructField("churned_date", T.TimestampNTZType()),
        T.StructField("last_event_type", T.StringType()),
        T.StructField("is_churned", T.IntegerType()),
        T.StructField("days_since_last_event", T.DoubleType()),
        T.StructField("days_since_signed", T.DoubleType()),
    ]
)

# One fixed schema for the union of all checks, whichever of them find something.
FINDINGS_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("inconsistency_type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("relevant_date", T.TimestampNTZType()),
        T.StructField("days_inactive", T.IntegerType()),
        T.StructField("signed_count", T.LongType()),
        T.StructField("churned_count", T.LongType()),
        T.StructField("application_count", T.LongType()),
        T.StructField("date_range_days", T.IntegerType()),
        T.StructField("record_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_date", T.TimestampNTZType()),
        T.StructField("plan", T.StringType()),
        T.StructField("sales_rep_id", T.LongType()),
        T.StructField("region", T.StringType()),
        T.StructField("marketing_channel", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("violation_type", T.StringType()),
        T.StructField("first_applied_date", T.TimestampNTZType()),
        T.StructField("first_signed_date", T.TimestampNTZType()),
        T.StructField("first_docs_date", T.TimestampNTZType()),
        T.StructField("first_rejected_date", T.TimestampNTZType()),
        T.StructField("first_churned_date", T.TimestampNTZType()),
        T.StructField("applied_count", T.LongType()),
        T.StructField("docs_count", T.LongType()),
        T.StructField("rejected_count", T.LongType()),
        T.StructField("first_applied", T.TimestampNTZType()),
        T.StructField("first_signed", T.TimestampNTZType()),
        T.StructField("unique_plans", T.LongType()),
        T.StructField("all_plans", T.StringType()),
        T.StructField("first_event", T.TimestampNTZType()),
        T.StructField("last_event", T.TimestampNTZType()),
    ]
)
