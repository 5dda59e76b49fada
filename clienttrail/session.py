"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Coalesce small and split skewed shuffle partitions; drop branches that turn out empty.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Event times are zone-less; only text formatting of instants would use the zone.
    "spark.sql.session.timeZone": "UTC",
    # Generated code beyond this size is never compiled by the JVM: such stages run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(builder: SparkSession.Builder | None = None) -> SparkSession:
    """Create a session with the settings above; anything else is the cluster's business."""
    builder = builder or SparkSession.builder.appName("clienttrail")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
