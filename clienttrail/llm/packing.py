"""Best-fit-decreasing packing of documents into windows of a fixed number of tokens.

Documents longer than a window are first cut into full windows; what is left of each, and every
shorter document, goes by decreasing length into the open window in which it fits most tightly. A
segment tree over the remaining capacities finds that window. Lengths and checksums of the pieces are
written once; they are a few bytes a piece, and packing reads them alone. Pieces are dealt by their
place in that table into shards of a fixed size, so that no key, however frequent, makes a shard large.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clienttrail.llm.common import read_table, stored, values_of
from clienttrail.llm.tokens import END_ID, default_tokenizer, word_tokenizer

WINDOW = 4096
#: Pieces that one task packs; a shard wastes at most a part of its last windows.
SHARD_PIECES = 100_000

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long"
)
_PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class TightestFit:
    """Open windows by remaining capacity, in a segment tree of how many there are of each."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self._leaves = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, capacity: int, change: int) -> None:
        node = self._leaves + capacity
        while node:
            self._count[node] += change
            node >>= 1

    def put(self, window: int, capacity: int) -> None:
        self._open[capacity].append(window)
        self._add(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return the window with the least remaining capacity of at least length, and that."""
        count = self._count
        node = self._leaves + length
        if not count[node]:
            # Up to the first right neighbour with open windows, then down to its leftmost leaf.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node <<= 1
                if not count[node]:
                    node += 1
        capacity = node - self._leaves
        window = self._open[capacity].pop()
        self._add(capacity, -1)
        return window, capacity


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset for each length (1 to window), in order of the list.

    Equal lengths are placed in the order of the list; the window opened last wins a tie.
    """
    places = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    tree, windows = TightestFit(window), 0
    for at in np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist():
        length = lengths[at]
        found = tree.take(length)
        if found is None:
            found = windows, window
            windows += 1
        number, capacity = found
        places[at], offsets[at] = number, window - capacity
        if capacity > length:
            tree.put(number, capacity - length)
    return places, offsets


def _cut(path: str, end_id: int, window: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = word_tokenizer(path, end_id)
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            rows = []
            for at, text in enumerate(values_of(batch.column("text"))):
                data = tokenizer.ids(text)
                total = len(data) // 4
                for start in range(0, total, window):
                    part = data[4 * start : 4 * (start + window)]
                    rows.append(
                        (ids_of[at], start, len(part) // 4, zlib.crc32(part), total, place)
                    )
                    place += 1
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                [c.split()[0] for c in _PIECES.split(", ")],
            )

    return pieces


def document_pieces(
    documents: DataFrame, path: str | None = None, end_id: int = END_ID, window: int = WINDOW
) -> DataFrame:
    """Cut every document's ids (those of its text and end_id) into windows and a rest.

    Rows: doc_id, start, length, ids_crc32, doc_tokens and place, unique in the table.
    A null or empty text is a document of end_id alone.
    """
    source = documents.select("doc_id", "text")
    return source.mapInArrow(_cut(path or default_tokenizer(), end_id, window), _PIECES)


def pack_pieces(pieces: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add sequence_id and offset to stored pieces. Full pieces get windows of their own."""
    shards = max(1, -(-pieces.count() // shard_pieces))
    if shards >= 1 << 22:
        raise ValueError("more shards than sequence numbers allow; raise shard_pieces")

    def pack(rows: pa.Table) -> pa.Table:
        # The result depends on the rows alone, not on the order in which they arrive.
        rows = rows.sort_by("place")
        places, offsets = best_fit_decreasing(rows.column("length").to_pylist(), window)
        sequences = (rows.column("shard").to_numpy() << 40) | places
        rows = rows.drop_columns(["place", "shard"])
        return rows.append_column("sequence_id", pa.array(sequences)).append_column(
            "offset", pa.array(offsets)
        )

    shard = F.pmod(F.xxhash64("place"), F.lit(shards)).alias("shard")
    return pieces.select("*", shard).groupBy("shard").applyInArrow(pack, _PACKED)


def pack_documents(
    documents: DataFrame,
    path: str | None = None,
    end_id: int = END_ID,
    window: int = WINDOW,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Pack all documents. A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each id of each document lies in exactly one piece; offsets within a sequence have no gaps. Repeated
    rows and ids are documents of their own. No documents give no rows.
    """
    pieces = stored(document_pieces(documents, path, end_id, window), "pieces")
    return pack_pieces(pieces, window, shard_pieces)


def pack_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents of the last stage, packed."""
    return pack_documents(documents)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
