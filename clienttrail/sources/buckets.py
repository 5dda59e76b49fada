"""The staged events bucketed by client, with very large clients in a table of their own.

A bucket is read by one task. Whatever is grouped by client needs no shuffle then, but a client with very many
events would make its bucket's task the slowest; so such clients are kept apart, unbucketed, and operators
are applied to both tables. No client is in both, so the union of the results is the whole result.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from clienttrail.operators.skew import HOT_ROWS, collect_hot_keys, join_hot
from clienttrail.schema import STAGED_SCHEMA

CLIENTS, LARGE = "clients", "large_clients"


class ClientTables(NamedTuple):
    """Staged events of ordinary clients (bucketed) and of very large ones (None: there are none)."""

    clients: DataFrame
    large: DataFrame | None


def write_client_buckets(
    staged: DataFrame, path: str, table: str, buckets: int, hot_rows: int = HOT_ROWS
) -> ClientTables:
    """Write staged events bucketed by client_id as the catalog table `table`, its files under `path`.

    Clients with more than `hot_rows` events go to a plain table. One file a bucket: the rows are dealt by the
    hash that buckets use.
    """
    spark = staged.sparkSession
    hot = collect_hot_keys(staged, ["client_id"], hot_rows)
    ordinary = staged if hot is None else join_hot(staged, hot, ["client_id"], "left_anti")
    large = staged.limit(0) if hot is None else join_hot(staged, hot, ["client_id"], "left_semi")
    large.write.mode("overwrite").parquet(f"{path}/{LARGE}")
    (
        ordinary.repartition(buckets, "client_id")
        .write.mode("overwrite")
        .bucketBy(buckets, "client_id")
        .sortBy("client_id")
        .option("path", f"{path}/{CLIENTS}")
        .saveAsTable(table)
    )
    return read_client_buckets(spark, path, table, buckets)


def read_client_buckets(spark: SparkSession, path: str, table: str, buckets: int) -> ClientTables:
    """The tables that write_client_buckets() wrote; a session that does not know `table` registers it."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STAGED_SCHEMA)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet"
            f" CLUSTERED BY (client_id) SORTED BY (client_id) INTO {buckets} BUCKETS"
            f" LOCATION '{path}/{CLIENTS}'"
        )
    large = spark.read.schema(STAGED_SCHEMA).parquet(f"{path}/{LARGE}")
    return ClientTables(spark.table(table), None if large.isEmpty() else large)


def per_client(tables: ClientTables, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """An operator whose rows each come from one client's events, applied to both tables."""
    result = operator(tables.clients)
    return result if tables.large is None else result.unionByName(operator(tables.large))
