from clienttrail.sources.buckets import (
    ClientTables,
    per_client,
    read_client_buckets,
    write_client_buckets,
)
from clienttrail.sources.tables import (
    preview,
    read_feature,
    read_raw_csv,
    read_staged,
    register_tables,
    write_table,
)

__all__ = [
    "ClientTables",
    "per_client",
    "preview",
    "read_client_buckets",
    "read_feature",
    "read_raw_csv",
    "read_staged",
    "register_tables",
    "write_client_buckets",
    "write_table",
]
