"""Lifecycle events made from the shared test tables (events, customer, nation, region).

The mapping is synthetic; it is chosen so that every branch of every operator is reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clienttrail.schema import RAW_COLUMNS

AS_OF = "2024-04-15 00:00:00"

# Stated so that no job has to read file footers first.
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, props string"
CUSTOMER = "c_custkey long, c_nationkey int"
NATION = "n_nationkey int, n_regionkey int"
REGION = "r_regionkey int, r_name string"

FIELDS = {
    "record_id": "event_id",
    "client_id": "user_id * 100 + (event_id * 7919) % 37",
    "event_type": """CASE event_type WHEN 'signup' THEN 'applied' WHEN 'view' THEN 'docs_submitted'
        WHEN 'error' THEN 'rejected' WHEN 'purchase' THEN 'signed'
        WHEN 'click' THEN 'churned' END""",
    # One day per 8 hours since the start: 30 days stretched to 90.
    "event_date": """CASE WHEN k <> 99 THEN date_add(DATE '2024-01-01',
        cast(datediff(ts, DATE '2024-01-01') * 3 + hour(ts) div 8 AS int)) END""",
    "plan": "CASE WHEN k % 10 <> 0 THEN elt(k % 3 + 1, 'basic', 'pro', 'premium') END",
    "region": "CASE WHEN k % 13 <> 0 THEN r_name END",
    "marketing_channel": """CASE WHEN k % 17 <> 0 THEN
        elt(k % 4 + 1, 'Email', 'Organic Search', 'Paid Ads', 'Referral') END""",
    "sales_rep_id": "CASE WHEN k % 11 <> 0 THEN 50 + k % 25 END",
    "source_system": """CASE WHEN k % 19 <> 0 THEN
        elt(k % 3 + 1, 'internal_form', 'web_api', 'manual_upload') END""",
}


def _read(spark: SparkSession, sf_dir: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{table}.parquet")


def _lookup(spark: SparkSession, sf_dir: str, table: str, schema: str) -> DataFrame:
    """A lookup table with one row per key, which lets Spark drop a left join nobody reads from."""
    key, value = (c.split()[0] for c in schema.split(", "))
    return _read(spark, sf_dir, table, schema).groupBy(key).agg(F.max(value).alias(value))


def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the raw schema, with gaps in every field that staging fills or drops.

    The region is that of the user as a customer. Plain left joins to scans add it: Spark
    broadcasts what is small, and splits the join to customers if one user has very many events.
    Where nobody reads the region, Spark drops the joins, as the lookups have one row per key.
    """
    # A pattern finds the one number in the JSON several times faster than a JSON parser.
    events = _read(spark, sf_dir, "events", EVENTS).withColumn(
        "k", F.expr("""try_cast(regexp_extract(props, '"k": *([0-9]+)') AS bigint)""")
    )
    customer = _lookup(spark, sf_dir, "customer", CUSTOMER)
    nation = _lookup(spark, sf_dir, "nation", NATION)
    region = _lookup(spark, sf_dir, "region", REGION)
    events = (
        events.join(customer, F.expr("user_id = c_custkey"), "left")
        .join(nation, F.expr("c_nationkey = n_nationkey"), "left")
        .join(region, F.expr("n_regionkey = r_regionkey"), "left")
    )
    return events.selectExpr(*[f"{FIELDS[c]} AS {c}" for c in RAW_COLUMNS])


def lifecycle_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as the text of a raw file, with unreadable dates and numbers in it."""
    raw = lifecycle_events(spark, sf_dir)
    text = {c: f"cast({c} AS string)" for c in RAW_COLUMNS}
    client, rep, date = (text[c] for c in ("client_id", "sales_rep_id", "event_date"))
    # By the last two digits of the record id: ids that are no number, have a fraction or a suffix;
    # reps with a fraction, a suffix or an exponent; dates in other formats, with offsets, bare years.
    text["client_id"] = f"""CASE record_id % 100 WHEN 5 THEN 'abc' WHEN 15 THEN {client} || '.5'
        WHEN 25 THEN {client} || 'd' WHEN 35 THEN {client} || '.0' ELSE {client} END"""
    text["sales_rep_id"] = f"""CASE record_id % 100 WHEN 7 THEN {rep} || '.9' WHEN 17 THEN {rep} || 'f'
        WHEN 27 THEN {rep} || 'e0' ELSE {rep} END"""
    text["event_date"] = f"""CASE WHEN event_date IS NULL THEN 'not-a-date'
        WHEN record_id % 100 = 9 THEN date_format(event_date, 'MM/dd/yyyy')
        WHEN record_id % 100 = 19 THEN date_format(event_date, 'MMM d, yyyy')
        WHEN record_id % 100 = 29 THEN {date} || 'T10:00:00+02:00'
        WHEN record_id % 100 = 39 THEN {date} || ' 10:00:00.25Z'
        WHEN record_id % 100 = 49 THEN '2024' ELSE {date} END"""
    return raw.selectExpr(*[f"{text[c]} AS {c}" for c in RAW_COLUMNS])
