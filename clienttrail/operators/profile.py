"""One row per client with all counts and dates that the funnel and the checks need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clienttrail.schema import APPLIED, CHURNED, DOCS_SUBMITTED, REJECTED, SIGNED

_TYPES = {
    "applied": APPLIED,
    "docs": DOCS_SUBMITTED,
    "rejected": REJECTED,
    "signed": SIGNED,
    "churned": CHURNED,
}
_PER_TYPE = (
    "count_if(event_type = '{type}') AS {name}_count",
    "min(CASE WHEN event_type = '{type}' THEN event_date END) AS first_{name}",
    "max(CASE WHEN event_type = '{type}' THEN event_date END) AS last_{name}",
)
_MERGES = {"count": "sum", "first": "min", "last": "max"}
_COLUMNS = (
    *[sql.format(name=n, type=t) for sql in _PER_TYPE for n, t in _TYPES.items()],
    "max(event_date) AS last_event",
)


def client_profile(events: DataFrame) -> DataFrame:
    """Per-client event counts and first and last dates.

    One hash aggregation, combined before its only shuffle, whose buffers are all of fixed width.
    Columns nobody reads are pruned from it, so every operator can start from this one.
    """
    return events.groupBy("client_id").agg(*map(F.expr, _COLUMNS))


def client_plan_profile(events: DataFrame) -> DataFrame:
    """client_profile() and the client's plans: unique_plans, plans (sorted), first_event.

    Events shrink to one row for each client and plan, and only those rows are brought together by client. The
    lists grow with the plan vocabulary only.
    """
    names = [sql.rsplit(" AS ", 1)[1] for sql in _COLUMNS]
    by_plan = events.groupBy("client_id", "plan").agg(
        *map(F.expr, _COLUMNS), F.min("event_date").alias("first_event")
    )
    merged = [
        F.expr(f"{_MERGES['count' if n.endswith('_count') else n.split('_')[0]]}({n}) AS {n}")
        for n in (*names, "first_event")
    ]
    plans = F.array_sort(F.collect_list("plan")).alias("plans")
    return by_plan.groupBy("client_id").agg(*merged, F.count("plan").alias("unique_plans"), plans)
