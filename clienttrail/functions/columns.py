"""Column expressions shared by the operators; all of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000

# Characters that `title_case` treats as letters of a word.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


# Patterns tried after ISO; a month comes before its day.
DATE_FORMATS = ("M/d/yyyy[ H:mm[:ss]]", "MMM d, yyyy[ H:mm[:ss]]", "MMMM d, yyyy", "d MMM yyyy")

# Dates in figures whose first two numbers may be month and day or day and month.
DAY_FIRST_FORMATS = ("d/M/yyyy[ H:mm[:ss]]", *DATE_FORMATS[1:])
_TWO_ORDERS = r"^\s*(\d{1,2})/(\d{1,2})/\d{4}\b"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_YEAR_ONLY = r"^\s*[+-]?\d+\s*$"
_OFFSET = r"\s*(?:Z|([+-])(\d{2}):?(\d{2}))\s*$"
_HAS_OFFSET = r"^\s*\d+-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}\S*" + _OFFSET


def lenient_long(col: Column, dtype: T.DataType, cut: bool = False) -> Column:
    """Cast to bigint; anything that is not a plain decimal or exponent number becomes null.

    Fractions are cut if `cut`; otherwise a number with a fraction becomes null, as an id that is cut
    would name another client. Text goes through bigint first so that ids beyond 2^53 stay exact.
    """
    if isinstance(dtype, T.IntegralType):
        return col.cast("bigint")
    if isinstance(dtype, T.StringType):
        # Whole numbers need no pattern; a small expression also leaves the generated code small enough
        # for the JVM to compile it together with what comes before.
        number = F.when(col.rlike(_NUMBER), F.trim(col)).try_cast("double")
        whole = number if cut else F.when(number % 1 == 0, number)
        return F.coalesce(col.try_cast("bigint"), whole.try_cast("bigint"))
    number = col if cut else F.when(col == F.floor(col), col)
    return number.try_cast("bigint")


def lenient_timestamp(
    col: Column, dtype: T.DataType, formats: Sequence[str] | None = None
) -> Column:
    """Cast to a zone-less timestamp; unreadable text, and a bare year, becomes null.

    ISO dates and timestamps are always read; those with an offset come out as UTC, whatever the
    session's zone. `formats` are the patterns tried after that, in order (None: DATE_FORMATS), value
    by value, so that one column may mix them.
    """
    if not isinstance(dtype, T.StringType):
        return col.cast("timestamp_ntz")
    local = F.regexp_replace(col, _OFFSET, "").try_cast("timestamp_ntz")
    sign = F.when(F.regexp_extract(col, _OFFSET, 1) == "-", -1).otherwise(1)
    hours, minutes = (
        F.coalesce(F.regexp_extract(col, _OFFSET, g).try_cast("int"), F.lit(0)) for g in (2, 3)
    )
    none = F.lit(0)
    moved = local - F.make_dt_interval(none, sign * hours, sign * minutes, F.lit(0).cast("decimal(18,6)"))
    extra = [
        F.try_to_timestamp(F.trim(col), F.lit(f)).cast("timestamp_ntz")
        for f in (DATE_FORMATS if formats is None else formats)
    ]
    plain = F.when(~col.rlike(_YEAR_ONLY), col.try_cast("timestamp_ntz"))
    return F.when(col.rlike(_HAS_OFFSET), moved).otherwise(F.coalesce(plain, *extra))


def date_order_numbers(col: Column) -> tuple[Column, Column]:
    """The first and second number of a date like 5/13/2023, null for other text."""
    first, second = (F.regexp_extract(col, _TWO_ORDERS, g).try_cast("int") for g in (1, 2))
    return first, second


def day_first_timestamp(col: Column) -> Column:
    """The reading of a date like 13/5/2023 whose day comes first; null for other text."""
    read = F.try_to_timestamp(F.trim(col), F.lit(DAY_FIRST_FORMATS[0]))
    return F.when(col.rlike(_TWO_ORDERS), read.cast("timestamp_ntz"))


def null_if_token(col: Column, tokens: Iterable[str]) -> Column:
    """Null where the text is one of the given missing-value tokens."""
    return F.when(~col.isin(*tokens), col)


def title_case(col: Column) -> Column:
    """Capitalise every run of letters, also after digits and punctuation: `Pro-Plus`.

    `initcap` only looks at spaces, so it is used where that is enough.
    """
    pieces = F.regexp_extract_all(col, F.lit(f"[^{_CASED}]*[{_CASED}]*"), F.lit(0))
    by_letter_run = F.array_join(
        F.transform(
            pieces,
            lambda p: F.concat(
                F.regexp_extract(p, f"^[^{_CASED}]*", 0),
                F.initcap(F.regexp_extract(p, f"[{_CASED}]*$", 0)),
            ),
        ),
        "",
    )
    return F.when(col.rlike(f"[^{_CASED} ][{_CASED}]"), by_letter_run).otherwise(F.initcap(col))


def as_of_literal(as_of: datetime | str) -> str:
    """The reporting instant as a SQL literal: zone-less UTC."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return f"TIMESTAMP_NTZ '{as_of.isoformat(sep=' ')}'"


def elapsed_days_sql(start: str, end: str) -> str:
    """SQL for the fractional days from start to end of zone-less timestamps.

    Exact to the microsecond and, unlike `timestampdiff`, the same in every session zone.
    """
    gap = f"({end} - {start})"
    micros = (
        f"cast(extract(DAY FROM {gap}) AS bigint) * {MICROS_PER_DAY}"
        f" + cast(extract(HOUR FROM {gap}) AS bigint) * 3600000000"
        f" + cast(extract(MINUTE FROM {gap}) AS bigint) * 60000000"
        f" + cast(extract(SECOND FROM {gap}) * 1000000 AS bigint)"
    )
    return f"(cast({micros} AS double) / {MICROS_PER_DAY}D)"


def elapsed_days(start: str, end: str) -> Column:
    """Fractional days from start to end, given as SQL."""
    return F.expr(elapsed_days_sql(start, end))


def whole_days(start: str, end: str) -> Column:
    """Whole 24-hour days from start to end, rounded down (so −1.5 days is −2)."""
    return F.floor(elapsed_days(start, end)).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def percent_text(rate: Column) -> Column:
    """A rate as text with one decimal, e.g. 0.777 -> `77.7%`.

    `format_number` with a pattern rounds the exact double half to even; `format_string` does not.
    """
    return F.concat(F.call_function("format_number", rate * 100, F.lit("0.0")), F.lit("%"))


def date_text(col: Column, missing: str = "-") -> Column:
    return F.coalesce(F.date_format(col, "yyyy-MM-dd"), F.lit(missing))


def month_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")
