"""Reading, registering and writing event and feature tables (CSV and Parquet)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from clienttrail.functions import null_if_token
from clienttrail.schema import NULL_TOKENS, STAGED_SCHEMA, TORN_RECORD
from clienttrail.sources.records import quoted_records


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    null_tokens: Iterable[str] = NULL_TOKENS,
    multiline: bool = False,
    keep_torn: bool = False,
) -> DataFrame:
    """Read raw CSV with a header, all columns as text; missing-value tokens become null.

    Columns go by header name, and files whose headers differ are an error. `multiline` allows line
    breaks inside quotes, at the price of another pass over the lines that hold quotes; files are read in
    splits either way. A record with too few or too many fields, as a line break in quotes makes without
    `multiline`, fails the read; with `keep_torn` it is kept whole in the column TORN_RECORD, which is null
    otherwise.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        # Fields are counted in whole records only.
        .option("columnPruning", False)
    )
    names = reader.csv(path).columns
    fields = [T.StructField(n, T.StringType()) for n in names]
    mode = {"mode": "FAILFAST"}
    if keep_torn:
        fields.append(T.StructField(TORN_RECORD, T.StringType()))
        mode = {"columnNameOfCorruptRecord": TORN_RECORD}
    schema = T.StructType(fields)
    if multiline:
        records = quoted_records(spark, path, names)
        ddl = ", ".join(f"`{field.name.replace('`', '``')}` string" for field in schema)
        parsed = F.from_csv("record", ddl, {"escape": '"', **mode})
        df = records.select(parsed.alias("fields")).select("fields.*")
    else:
        df = reader.options(**mode).schema(schema).csv(path)
    tokens = tuple(null_tokens)
    if not tokens:
        return df
    columns = [null_if_token(F.col(f"`{c}`"), tokens).alias(c) for c in names]
    return df.select(*columns, *([TORN_RECORD] if keep_torn else []))


def read_feature(
    spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Read a table that `write_table` wrote, with its fixed schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        # Times are read as text and cast: a pattern has one number of fraction digits, text any.
        text = [
            T.StructField(f.name, T.StringType() if _is_time(f) else f.dataType) for f in schema
        ]
        read = (
            spark.read.schema(T.StructType(text))
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .csv(path)
        )
        times = {f.name: F.col(f.name).cast(f.dataType) for f in schema if _is_time(f)}
        return read.withColumns(times).select(*schema.names)
    # A column that the table is partitioned by comes last when it is read.
    return reader.format(fmt).load(path).select(*schema.names)


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.TimestampNTZType)


def read_staged(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Read the staged event table."""
    return read_feature(spark, path, STAGED_SCHEMA, fmt)


def register_tables(tables: Mapping[str, DataFrame]) -> None:
    """Make frames available to `spark.sql` under the given names, replacing earlier ones."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    only_present: bool = False,
) -> str:
    """Write a table and return its path; CSV gets a header and dates as text.

    With `partition_by` each value of these columns has a folder of its own, which filters on them prune.
    `only_present` replaces the folders of values that occur in df and leaves those of other values.
    """
    if fmt == "csv":
        # As text, a time without a fraction has none and any other keeps all its digits.
        times = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
        df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in times})
        writer = df.write.mode(mode).option("header", True).option("escape", '"')
    else:
        writer = df.write.mode(mode)
    if only_present:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).format(fmt).save(path)
    return path


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows, for a look at a table."""
    return df.limit(rows)
