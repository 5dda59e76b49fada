from clienttrail.functions.columns import (
    as_of_literal,
    date_order_numbers,
    date_text,
    day_first_timestamp,
    elapsed_days,
    elapsed_days_sql,
    lenient_long,
    lenient_timestamp,
    month_text,
    null_if_token,
    percent_text,
    ratio,
    title_case,
    whole_days,
)

__all__ = [
    "as_of_literal",
    "date_order_numbers",
    "date_text",
    "day_first_timestamp",
    "elapsed_days",
    "elapsed_days_sql",
    "lenient_long",
    "lenient_timestamp",
    "month_text",
    "null_if_token",
    "percent_text",
    "ratio",
    "title_case",
    "whole_days",
]
