"""CSV records with line breaks in quotes, read in as many tasks as the files have splits.

Files are read as lines. A first pass looks only at lines that hold a quote and finds, for each split, whether
a reader that enters it inside or outside quotes leaves it inside or outside. Put together in the order of
splits (one small entry for each split, on the driver) this tells every split how it begins. A second pass
joins the lines of each record within its split; a record cut by the end of a split leaves pieces, and only
those pieces are shuffled.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Splits with quotes that the driver and each executor keep an entry for: four numbers of 8 bytes.
MAX_SPLITS = 4_000_000
_NONE = -1
_SPLIT = "path string, file long, start long, length long, out_end boolean, in_end boolean, in_closed boolean"
_RECORD = "record string, file long, owner long, start long"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a reader that enters a line inside a quoted field, or at a field's start, leaves it inside one.

    Two quotes in a quoted field stand for one; a quote within a field that does not begin with one is text.
    """
    at = 0
    while True:
        if not inside:
            if not line.startswith('"', at):
                at = line.find(',"', at) + 1
                if not at:
                    return False
            at += 1
        inside = True
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('""', at):
            at += 2
            continue
        at = line.find(",", at) + 1
        if not at:
            return False
        inside = False


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
    )


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split that holds quotes: how it is left by those who enter it outside and inside."""
    found: dict[tuple, list[bool]] = {}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("path", "file", "start", "length")]
        for line, *split in zip(batch.column("value").to_pylist(), *columns):
            state = found.setdefault(tuple(split), [False, True, False])
            state[0], state[1] = ends_inside(line, state[0]), ends_inside(line, state[1])
            state[2] |= not state[1]
    rows = [(*split, *state) for split, state in found.items()]
    names = [field.split()[0] for field in _SPLIT.split(", ")]
    yield pa.RecordBatch.from_pylist(
        [dict(zip(names, row)) for row in rows],
        pa.schema(
            [("path", pa.string()), *[(n, pa.int64()) for n in names[1:4]], *[(n, pa.bool_()) for n in names[4:]]]
        ),
    )


class Splits:
    """For each file its splits with quotes, and the split where the record began that each is entered within."""

    def __init__(self, rows: list, max_splits: int = MAX_SPLITS):
        if len(rows) > max_splits:
            raise ValueError(f"{len(rows)} splits hold quotes; raise spark.sql.files.maxPartitionBytes")
        files: dict[int, list] = {}
        for row in sorted(rows, key=lambda r: (r["file"], r["start"])):
            files.setdefault(row["file"], []).append(row)
        self.files: dict[int, np.ndarray] = {}
        for file, own in files.items():
            if len({r["path"] for r in own}) > 1:
                raise ValueError("two file names share a hash; read them one at a time")
            owner, entries = _NONE, []
            for row in own:
                before, begins = owner, owner == _NONE or row["in_closed"]
                inside = row["out_end"] if owner == _NONE else row["in_end"]
                owner = (row["start"] if begins else owner) if inside else _NONE
                entries.append((row["start"], row["length"], before, owner))
            if owner != _NONE:
                raise ValueError(f"a quote is not closed in {own[0]['path']}")
            self.files[file] = np.array(entries, np.int64)

    def entered(self, file: int, start: int, length: int) -> tuple[int, bool]:
        """The split where the record began that a split is entered within (or none), and if it may hold quotes."""
        entries = self.files.get(file)
        if entries is None:
            return _NONE, False
        place = int(np.searchsorted(entries[:, 0], start))
        if place < len(entries) and entries[place, 0] == start and entries[place, 1] == length:
            return int(entries[place, 2]), True
        return (int(entries[place - 1, 3]) if place else _NONE), False

    def cut(self) -> list[tuple[int, int]]:
        """Where records begin that do not end in their split: (file, start)."""
        return [(f, int(o)) for f, entries in self.files.items() for o in np.unique(entries[:, 3]) if o != _NONE]


def _check_header(record: str, names: list[str]) -> None:
    found = next(csv.reader([record], strict=False), [])
    plain = all(found) and len({name.lower() for name in found}) == len(found)
    if len(found) != len(names) or (plain and found != names):
        raise ValueError(f"a file has the header {found}, another one {names}")


def _records(shared, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records of each split in order; pieces of cut ones have the split where they began as owner."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits, split = shared.value, None
        owner, known, header, held = _NONE, False, False, []

        def left() -> Iterator[pa.RecordBatch]:
            if held:
                if header:
                    raise ValueError("the header does not end in the first split of a file")
                yield _batch(["\n".join(held)], split, split[1] if owner == _NONE else owner)

        for batch in batches:
            lines = batch.column("value")
            quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
            where = [batch.column(c).to_numpy() for c in ("file", "start", "length")]
            changes = np.any([np.diff(w) != 0 for w in where[:2]], axis=0)
            edges = [0, *(np.flatnonzero(changes) + 1).tolist(), len(batch)]
            for first, end in zip(edges, edges[1:]):
                here = tuple(int(w[first]) for w in where)
                if here != split:
                    yield from left()
                    split, held = here, []
                    owner, known = splits.entered(*here)
                    header = here[1] == 0
                if quoted[first:end].any() and not known:
                    raise ValueError("files or splits changed while they were read; set spark.sql.files.minPartitionNum")
                if not header and not held and owner == _NONE and not quoted[first:end].any():
                    yield _batch(lines.slice(first, end - first), split, None)
                    continue
                whole = []
                for line in lines.slice(first, end - first).to_pylist():
                    inside = bool(held) or owner != _NONE
                    held.append(line)
                    if ends_inside(line, inside):
                        continue
                    record, held = "\n".join(held), []
                    if owner != _NONE:
                        yield _batch([record], split, owner)
                        owner = _NONE
                    elif header and record.strip():
                        _check_header(record, names)
                        header = False
                    elif not header:
                        whole.append(record)
                yield _batch(whole, split, None)
        yield from left()

    return join


def _batch(records, split: tuple[int, int, int], owner: int | None) -> pa.RecordBatch:
    size = len(records)
    numbers = [pa.array([value] * size, pa.int64()) for value in (split[0], owner, split[1])]
    texts = records if isinstance(records, pa.Array) else pa.array(records, pa.string())
    return pa.RecordBatch.from_arrays([texts, *numbers], ["record", "file", "owner", "start"])


def quoted_records(
    spark: SparkSession, path: str | list[str], names: list[str], max_splits: int = MAX_SPLITS
) -> DataFrame:
    """The records of CSV files with a header, one text each (column `record`), without headers and blank lines.

    Line breaks within a record become a line feed. A quote that is never closed is an error, as is a header
    other than names. Splits must be the same in both passes over the files, which is checked.
    """
    lines = _lines(spark, path)
    passages = lines.where(F.contains("value", F.lit('"'))).mapInArrow(_passages, _SPLIT)
    splits = Splits(passages.collect(), max_splits)
    shared = spark.sparkContext.broadcast(splits)
    join = _records(shared, names)
    columns = ["value", "file", "start", "length"]
    whole = lines.select(*columns).mapInArrow(join, _RECORD).where("owner is null").select("record")
    if cut := splits.cut():
        files = spark.createDataFrame([(file,) for file in sorted({file for file, _ in cut})], "file long")
        pieces = lines.select(*columns).join(F.broadcast(files), "file", "left_semi")
        pieces = pieces.mapInArrow(join, _RECORD).where("owner is not null")
        in_order = F.sort_array(F.collect_list(F.struct("start", "record")))
        joined = pieces.groupBy("file", "owner").agg(F.array_join(in_order["record"], "\n").alias("record"))
        whole = whole.unionAll(joined.select("record"))
    return whole.where(F.trim("record") != "")
