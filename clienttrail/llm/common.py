"""What several operators share: shared storage, words, stable hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are maximal runs of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bytes of rows that travel to a Python worker together, and of texts that one looks at together.
BATCH_BYTES, SLICE_BYTES = 8 << 20, 2 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes.split() splits at exactly the six ASCII white-space characters."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Where that is unset, a folder of our own, but only if the executors run on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = Path(tempfile.mkdtemp(prefix="llm-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def values_of(column: pa.Array) -> Iterator:
    """The values of an Arrow column one by one: a list of them would hold all texts of a batch again."""
    return (value.as_py() for value in column)


def few_rows(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts together take `size` bytes at most, beside the first of a slice."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    place = np.cumsum(lengths) // size
    edges = [*np.flatnonzero(np.diff(place, prepend=-1)).tolist(), len(batch)]
    for start, end in zip(edges, edges[1:]):
        yield batch.slice(start, end - start)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage: a lost executor costs no recomputation of what came before, later steps do
    not run the earlier ones again, and the planner knows the size of what it reads.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Let no more than BATCH_BYTES of rows at a time travel to a Python worker, texts being long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; sets the session's bound on batches for Python."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> list:
    """128 bits that stand for a text: two hash columns, key_a and key_b (of the empty text if null)."""
    value = F.coalesce(F.col(text), F.lit(""))
    return [
        F.xxhash64(value).alias("key_a"),
        F.xxhash64(F.lit("second"), value, F.length(value)).alias("key_b"),
    ]


def smallest_of_each(df: DataFrame, group: str, count: int, *order) -> DataFrame:
    """The first count rows of each group in an order that has a hash as its first column.

    Groups are counted first. Of a large group only rows are ranked whose hash is under a bound that leaves about
    four times the wanted rows. Where that leaves too few, as copies share a hash, the group is ranked whole.
    """
    sizes = stored(df.groupBy(group).agg(F.count("*").alias("rows")), "group-sizes")
    part = F.least(F.lit(1.0), F.lit(4.0 * count) / F.col("rows"))
    bounds = sizes.select(
        F.col(group).alias("of_group"),
        (part * F.lit(float(1 << 64)) - F.lit(float(1 << 63))).alias("bound"),
    )
    same = F.col(group).eqNullSafe(F.col("of_group"))
    low = df.join(bounds, same).where(F.col("hash").cast("double") <= F.col("bound"))
    ranked = stored(low.drop("of_group", "bound"), "low-hashes")

    left = ranked.groupBy(F.col(group).alias("of_group")).agg(F.count("*").alias("left"))
    too_few = F.coalesce("left", F.lit(0)) < F.least("rows", F.lit(count))
    lacking = sizes.join(left, same, "left").where(too_few).select(F.col(group).alias("of_group"))
    if not lacking.isEmpty():
        ranked = ranked.join(lacking, same, "left_anti").unionByName(df.join(lacking, same, "left_semi"))
    first = F.row_number().over(Window.partitionBy(group).orderBy("hash", *order))
    return ranked.withColumn("place", first).where(F.col("place") <= count).drop("place")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct named row, whatever their names; select row.* to get them back."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")


def one_row_per_document(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of documents whose (doc_id, text) is in chosen, one row for each such pair.

    chosen has doc_id and the text_key() columns. Nulls match nulls. The semi join and the row number
    share one shuffle.
    """
    keyed = documents.select(whole_row(documents), "doc_id", *text_key())
    keys = ["doc_id", "key_a", "key_b"]
    wanted = chosen.select(*[F.col(k).alias(f"wanted_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"wanted_{k}")) for k in keys]
    order = Window.partitionBy(*keys).orderBy(*keys)
    return (
        keyed.join(wanted, same[0] & same[1] & same[2], "left_semi")
        .withColumn("copy", F.row_number().over(order))
        .where("copy = 1")
        .select("row.*")
    )
