"""Rank of each event among its client's events of the same type.

A plain `row_number` window puts a whole (client, event type) group into one task. That is fine
for ordinary groups and is what they get. A group with more than `hot_rows` rows is cut into
slices of its sort order instead: each slice is ranked on its own and shifted by the number of
rows in the slices before it. The slice limits are values picked from the data by hash, so every
evaluation of the plan (also after a lost executor) cuts at the same places; which values are
picked decides only how even the slices are, never the ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clienttrail.operators.skew import HOT_ROWS, collect_hot_keys, join_hot

GROUP = ["client_id", "event_type"]
ORDER = ["event_date", "record_id"]

SLICE_ROWS = 5_000_000
COPIES_PER_TASK_ROW = 1_000_000


def with_event_rank(
    events: DataFrame,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
    copies_per_task_row: int = COPIES_PER_TASK_ROW,
) -> DataFrame:
    """Add `event_rank`, 1 for the earliest event of a type; ties go by `record_id`.

    Looking for large groups runs a small job over the two group columns right away.
    """
    return rank_events(
        events, collect_hot_keys(events, GROUP, hot_rows), slice_rows, copies_per_task_row
    )


def rank_events(
    events: DataFrame,
    hot: DataFrame | None,
    slice_rows: int = SLICE_ROWS,
    copies_per_task_row: int = COPIES_PER_TASK_ROW,
) -> DataFrame:
    """with_event_rank() for large groups that are known already (None: there are none).

    Nothing runs while the plan is built. Which groups are listed decides how they are cut, not the ranks.
    """
    if hot is None:
        return _rank_whole(events)
    ordinary = _rank_whole(join_hot(events, hot, GROUP, "left_anti"))
    return ordinary.unionByName(_rank_hot(events, hot, slice_rows, copies_per_task_row))


def _tie_break(columns: list[str]) -> Column:
    """Orders rows that agree in date and record id, so that only exact copies are tied."""
    return F.xxhash64(*[c for c in columns if c not in (*GROUP, *ORDER)])


def _rank_whole(events: DataFrame) -> DataFrame:
    in_group = Window.partitionBy(*GROUP).orderBy(*ORDER, _tie_break(events.columns))
    return events.withColumn("event_rank", F.row_number().over(in_group).cast("bigint"))


def _rank_hot(
    events: DataFrame, hot: DataFrame, slice_rows: int, copies_per_task_row: int
) -> DataFrame:
    columns = events.columns

    # Exact copies of a row would all land in one slice, so they travel as one row and a count.
    rows = (
        join_hot(events, hot, GROUP, "left_semi")
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_key", F.struct(*ORDER, _tie_break(columns).alias("_tie")))
    )

    # About one row in `slice_rows` is a limit: as many in all as there are slices.
    limits = (
        rows.where(F.pmod(F.xxhash64("_key"), F.lit(slice_rows)) == 0)
        .groupBy(*GROUP)
        .agg(F.array_sort(F.collect_set("_key")).alias("_limits"))
    )
    sliced = (
        join_hot(rows, limits, GROUP, "left")
        .withColumn("_slice", _limits_up_to(F.col("_limits"), F.col("_key")))
        .drop("_limits")
    )

    in_order = Window.partitionBy(*GROUP).orderBy("_slice")
    before_slice = (
        sliced.groupBy(*GROUP, "_slice")
        .agg(F.sum("_copies").alias("_n"))
        .withColumn("_offset", F.sum("_n").over(in_order) - F.col("_n"))
        .drop("_n")
    )

    in_slice = Window.partitionBy(*GROUP, "_slice").orderBy("_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last_rank = F.col("_offset") + F.col("_through")
    ranked = join_hot(
        sliced.withColumn("_through", F.sum("_copies").over(in_slice)),
        before_slice,
        [*GROUP, "_slice"],
        "left",
    ).select(*columns, (last_rank - F.col("_copies")).alias("_before"), last_rank.alias("_last"))
    return _expand_copies(ranked, columns, copies_per_task_row)


def _limits_up_to(limits: Column, key: Column) -> Column:
    """How many of the sorted limits are <= key: a binary search from the highest bit down.

    It counts to 2^25 - 1. Beyond so many limits (a group of some 10^14 rows) the last slice only
    grows; ranks stay right.
    """
    steps = F.array(*[F.lit(1 << bit) for bit in range(24, -1, -1)])
    return F.when(limits.isNull(), F.lit(0)).otherwise(
        F.aggregate(
            steps,
            F.lit(0),
            lambda found, step: F.when(F.get(limits, found + step - 1) <= key, found + step)
            .otherwise(found),
        )
    )


def _expand_copies(ranked: DataFrame, columns: list[str], copies_per_task_row: int) -> DataFrame:
    """One output row per copy; only rows with very many copies are spread over the tasks."""

    def expanded(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        return rows.select(*columns, F.explode(F.sequence(first, last)).alias("event_rank"))

    many = F.col("_last") - F.col("_before") > copies_per_task_row
    few = expanded(ranked.where(~many), F.col("_before") + 1, F.col("_last"))
    # A fixed partition count: adaptive execution would merge these few small rows into one task.
    tasks = int(ranked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.lit(copies_per_task_row).cast("bigint")
    starts = F.sequence(F.col("_before"), F.col("_last") - 1, size)
    spread = (
        ranked.where(many)
        .withColumn("_start", F.explode(starts))
        .repartition(tasks, *columns, "_start")
    )
    end = F.least(F.col("_start") + size, F.col("_last"))
    return few.unionByName(expanded(spread, F.col("_start") + 1, end))
