"""Keys that hold very many rows: how to find them and how to join to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 20_000_000
BUCKETS = 1 << 20


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Key combinations with more than `hot_rows` rows; a plan, nothing runs here.

    There are at most (all rows / hot_rows) of them. Rows are counted per hash bucket first, which shuffles
    almost nothing, and only keys in crowded buckets are counted exactly: without a crowded bucket, adaptive
    execution drops the exact count.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket")
    crowded = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    return (
        df.select(*keys, bucket)
        .join(F.broadcast(crowded.select("_bucket")), "_bucket", "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(*keys)
    )


def collect_hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame | None:
    """hot_keys(), found right away, or None if there are none.

    They fit in the driver and in a broadcast; being collected, they are the same wherever the plan uses them.
    """
    hot = hot_keys(df, keys, hot_rows)
    found = hot.collect()
    return df.sparkSession.createDataFrame(found, hot.schema) if found else None


def join_hot(left: DataFrame, hot: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join to one row per hot key (or slice of it), which is few enough to broadcast.

    Null keys match null keys.
    """
    renamed = hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    return left.join(F.broadcast(renamed), match, how).drop(*[f"_hot_{k}" for k in keys])
