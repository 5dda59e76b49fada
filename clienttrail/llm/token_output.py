"""Packed token ids as binary rows: id matrices, cumulative segment lengths, positions.

Each task packs what it reads, a few million tokens at a time, best fit decreasing with a segment tree;
token ids are never shuffled. Documents longer than a window are cut without loss into full windows and
a rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clienttrail.llm.common import read_table, shared_dir, values_of
from clienttrail.llm.packing import WINDOW, best_fit_decreasing
from clienttrail.llm.tokens import END_ID, default_tokenizer, word_tokenizer

#: Tokens that a task packs together.
SHARD_TOKENS = 4_000_000
PAD_ID = 0

_SCHEMA = (
    "sequence_id long, n_tokens int, doc_ids array<long>, starts array<long>, "
    "cu_seqlens array<int>, ids binary, positions binary"
)
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]
_TYPES = [
    pa.int64(),
    pa.int32(),
    pa.list_(pa.int64()),
    pa.list_(pa.int64()),
    pa.list_(pa.int32()),
    pa.binary(),
    pa.binary(),
]


def pack_shard(
    segments: list[tuple[int | None, int, np.ndarray]], window: int, first_id: int, id_type: str
) -> pa.RecordBatch:
    """Pack segments (doc_id, start, ids) of at most window ids into rows of the schema."""
    places, offsets = best_fit_decreasing([len(s[2]) for s in segments], window)
    rows = int(places.max()) + 1
    ids = np.full((rows, window), PAD_ID, id_type)
    positions = np.zeros((rows, window), "<u4")
    inside: list[list[int]] = [[] for _ in range(rows)]
    for number in np.lexsort((offsets, places)).tolist():
        _, _, own = segments[number]
        row, at = places[number], offsets[number]
        ids[row, at : at + len(own)] = own
        positions[row, at : at + len(own)] = np.arange(len(own))
        inside[row].append(number)
    ends = [np.cumsum([0, *(len(segments[n][2]) for n in row)]).tolist() for row in inside]
    columns = [
        range(first_id, first_id + rows),
        [e[-1] for e in ends],
        [[segments[n][0] for n in row] for row in inside],
        [[segments[n][1] for n in row] for row in inside],
        ends,
        [r.tobytes() for r in ids],
        [r.tobytes() for r in positions],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def _pack(path: str, end_id: int, window: int, shard_tokens: int, id_type: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = word_tokenizer(path, end_id)
        next_id = TaskContext.get().partitionId() << 40
        segments: list[tuple[int | None, int, np.ndarray]] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), values_of(batch.column("text"))):
                ids = np.frombuffer(tokenizer.ids(text), "<u4")
                if ids.max() > np.iinfo(id_type).max:
                    raise ValueError(f"token ids do not fit {id_type}")
                ids = ids.astype(id_type)
                for start in range(0, len(ids), window):
                    segments.append((doc_id, start, ids[start : start + window]))
                held += len(ids)
                if held >= shard_tokens:
                    yield (packed := pack_shard(segments, window, next_id, id_type))
                    next_id += packed.num_rows
                    segments, held = [], 0
        if segments:
            yield pack_shard(segments, window, next_id, id_type)

    return pack


def packed_sequences(
    documents: DataFrame,
    path: str | None = None,
    end_id: int = END_ID,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    id_type: str = "<u2",
) -> DataFrame:
    """One row per window: sequence_id, n_tokens, doc_ids, starts, cu_seqlens, ids, positions.

    ids is the window's row of the id matrix (little-endian id_type, padded with PAD_ID), positions holds
    unsigned 32-bit positions that start at 0 with each segment, cu_seqlens runs from 0 to n_tokens, and
    doc_ids and starts say which ids of which document each segment holds. A null or empty text is a
    document of end_id alone; repeated rows are documents of their own; no documents give no rows.
    """
    pack = _pack(path or default_tokenizer(), end_id, window, shard_tokens, id_type)
    return documents.select("doc_id", "text").mapInArrow(pack, _SCHEMA)


def write_sequences(documents: DataFrame, folder: str, **options) -> None:
    """Write the packed matrices as Parquet, whose commit leaves out what lost tasks wrote."""
    packed_sequences(documents, **options).write.option("compression", "zstd").parquet(folder)


def unpack(rows: list, id_type: str = "<u2") -> dict[int, list[int]]:
    """The ids of each document from rows of packed_sequences() (ids of documents must differ)."""
    parts: dict[int, list[tuple[int, list[int]]]] = {}
    for row in rows:
        ids = np.frombuffer(row["ids"], id_type)
        edges = row["cu_seqlens"]
        for doc_id, start, low, high in zip(row["doc_ids"], row["starts"], edges, edges[1:]):
            parts.setdefault(doc_id, []).append((start, ids[low:high].tolist()))
    return {d: [i for _, own in sorted(found) for i in own] for d, found in parts.items()}


def op3_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the matrices to the shared folder; per window its segments and checksums of what was written."""
    folder = f"{shared_dir(spark)}/packed-{uuid.uuid4().hex}"
    write_sequences(read_table(spark, sf_dir, "documents"), folder)
    written = spark.read.schema(_SCHEMA).parquet(folder)
    return written.select(
        "sequence_id",
        "n_tokens",
        (F.size("cu_seqlens") - 1).alias("n_segments"),
        "doc_ids",
        "starts",
        "cu_seqlens",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"),
    )
