"""Staging: lenient casts, default fills, projection and ranking of repeated events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from clienttrail.functions import (
    date_order_numbers,
    day_first_timestamp,
    lenient_long,
    lenient_timestamp,
    title_case,
)
from clienttrail.operators.ranking import with_event_rank
from clienttrail.schema import NO_SALES_REP, NUMERIC_COLUMNS, RAW_COLUMNS, TORN_RECORD, UNKNOWN


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for spaces."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Fail while the plan is built if a column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def _casts(df: DataFrame, date_formats: Sequence[str] | None) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema}
    casts = {
        c: lenient_long(F.col(c), types[c], cut=c == "sales_rep_id")
        for c in NUMERIC_COLUMNS
        if c in types
    }
    if "event_date" in types:
        casts["event_date"] = lenient_timestamp(
            F.col("event_date"), types["event_date"], date_formats
        )
    return casts


def cast_events(df: DataFrame, date_formats: Sequence[str] | None = None) -> DataFrame:
    """Cast the date and the numeric columns that are present; bad values become null."""
    return df.withColumns(_casts(df, date_formats))


def _lost_values(df: DataFrame, casts: dict[str, Column]) -> Column:
    """The values of a record that its casts lose, or the whole record if it is torn: an array of structs."""
    lost = [
        F.when(
            F.col(c).isNotNull() & cast.isNull(),
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")),
        )
        for c, cast in casts.items()
    ]
    if TORN_RECORD in df.columns:
        torn = F.col(TORN_RECORD)
        whole = F.struct(F.lit(TORN_RECORD).alias("column_name"), torn.alias("value"))
        lost = [F.when(torn.isNull(), value) for value in lost] + [F.when(torn.isNotNull(), whole)]
    return F.array_compact(F.array(*lost))


def unreadable_values(df: DataFrame, date_formats: Sequence[str] | None = None) -> DataFrame:
    """What casting loses: a row (record_id, column_name, value) for each value that becomes null.

    record_id is the record's own text. Records that the source found torn, if it was asked to keep
    them, are listed whole as the value of the column TORN_RECORD.
    """
    record = F.col("record_id").cast("string").alias("record_id")
    return df.select(record, F.inline(_lost_values(df, _casts(df, date_formats))))


def fill_missing(df: DataFrame) -> DataFrame:
    """Fill plan, channel, source and sales rep where present; the region is left as it is."""
    defaults = {
        "plan": title_case(F.coalesce("plan", F.lit(UNKNOWN))),
        "source_system": F.coalesce("source_system", F.lit(UNKNOWN)),
        "marketing_channel": F.coalesce("marketing_channel", F.lit(UNKNOWN)),
        "sales_rep_id": F.coalesce("sales_rep_id", F.lit(NO_SALES_REP).cast("bigint")),
    }
    return df.withColumns({c: e for c, e in defaults.items() if c in df.columns})


def clean_events(df: DataFrame, date_formats: Sequence[str] | None = None) -> DataFrame:
    """Raw events -> typed, filled events with a date; a narrow plan without a shuffle.

    Torn records, if the source kept them, are left out.
    """
    if TORN_RECORD in df.columns:
        df = df.where(F.col(TORN_RECORD).isNull())
    return (
        require_columns(df)
        .transform(cast_events, date_formats)
        .transform(fill_missing)
        .where(F.col("event_date").isNotNull())
        .select(*RAW_COLUMNS)
    )


def date_order_counts(df: DataFrame) -> dict[str, Column]:
    """Aggregates over the raw date column: dates whose day can only come first, only second, or either way.

    5/13/2023 has its month first, 13/5/2023 its day; 5/6/2023 does not tell. Other text is not counted.
    """
    if not isinstance(df.schema["event_date"].dataType, T.StringType):
        return {name: F.lit(0).cast("long") for name in ("day_first", "month_first", "ambiguous")}
    first, second = date_order_numbers(F.col("event_date"))
    low = first.between(1, 12) & second.between(1, 12)
    return {
        "day_first": F.count_if(first.between(13, 31) & second.between(1, 12)),
        "month_first": F.count_if(first.between(1, 12) & second.between(13, 31)),
        "ambiguous": F.count_if(low & (first != second)),
    }


def date_order(df: DataFrame) -> DataFrame:
    """How the dates in figures of a raw table are written, from the whole column: one row.

    `date_order` is `day` or `month` if all dates that tell agree, `mixed` if they do not, null if none tells.
    """
    return df.agg(*[c.alias(n) for n, c in date_order_counts(df).items()]).select(
        F.lit("event_date").alias("column_name"), "*", date_order_of("day_first", "month_first").alias("date_order")
    )


def date_order_of(day_first: str, month_first: str) -> Column:
    day, month = F.col(day_first) > 0, F.col(month_first) > 0
    return F.when(day & month, "mixed").when(day, "day").when(month, "month")


def parse_events(df: DataFrame, date_formats: Sequence[str] | None = None) -> DataFrame:
    """Raw events -> one row for each record with all that staging keeps of it, in one narrow pass.

    `event` is the typed and filled event (null for torn records), `day_first` its date read with the day
    first if it may be, `record` the text of its record_id and `lost` what could not be read; parsed_events()
    and parsed_losses() take them apart. The table of it is read as often as needed in place of the raw text.
    """
    require_columns(df)
    kept = [c for c in df.columns if c in (*RAW_COLUMNS, TORN_RECORD)]
    casts = _casts(df, date_formats)
    written = isinstance(df.schema["event_date"].dataType, T.StringType) and date_formats is None
    day_first = day_first_timestamp(F.col("event_date")) if written else F.lit(None).cast("timestamp_ntz")
    # Each value is cast once, under a name of its own, and both results start from that.
    cast = df.select(*kept, day_first.alias("day_first"), *[e.alias(f"_cast_{c}") for c, e in casts.items()])
    lost = _lost_values(cast, {c: F.col(f"_cast_{c}") for c in casts})
    record = F.col("record_id").cast("string").alias("record")
    typed = [F.col(f"_cast_{c}").alias(c) if c in casts else F.col(c) for c in RAW_COLUMNS]
    torn = [TORN_RECORD] if TORN_RECORD in kept else []
    filled = cast.select(record, lost.alias("lost"), "day_first", *torn, *typed).transform(fill_missing)
    event = F.struct(*RAW_COLUMNS)
    event = F.when(F.col(TORN_RECORD).isNull(), event) if torn else event
    return filled.select("record", "lost", "day_first", event.alias("event"))


def parsed_events(parsed: DataFrame, day_first: bool = False) -> DataFrame:
    """The cleaned events of parse_events(), as clean_events() gives them.

    With `day_first` dates in figures are read with the day first.
    """
    date = F.col("event.event_date")
    date = F.coalesce("day_first", date) if day_first else date
    columns = [date.alias(c) if c == "event_date" else F.col(f"event.{c}") for c in RAW_COLUMNS]
    return parsed.where("event is not null").select(*columns).where("event_date is not null")


def parsed_losses(parsed: DataFrame, day_first: bool = False) -> DataFrame:
    """The unreadable values of parse_events(), as unreadable_values() gives them."""
    found = parsed.select("day_first", F.col("record").alias("record_id"), F.inline("lost"))
    if day_first:
        found = found.where((F.col("column_name") != "event_date") | F.col("day_first").isNull())
    return found.drop("day_first")


def stage_events(df: DataFrame, date_formats: Sequence[str] | None = None) -> DataFrame:
    """Raw events -> the staged table: cleaned events plus `event_rank`."""
    return with_event_rank(clean_events(df, date_formats))
