"""Substring deduplication: windows of words that occur more than once, found with FM-indexes.

All windows of one text whose smallest eight-word hash (the anchor) is the same form a segment. Equal
windows have equal anchors, so segments are dealt to shards by anchor and a window is only ever
compared within its shard. Anchors that occur once in the corpus are left out, equal segments count as
one with a weight, and each shard indexes its segments in an FM-index over a wavelet matrix and streams
them through it. Work and storage grow with the corpus, whatever the number of shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clienttrail.llm.common import read_table, stored, text_key, values_of, whole_row, words_of
from clienttrail.llm.fm_index import FmIndex

WINDOW = 35
ANCHOR_WORDS = 8
#: Words that one shard's index holds on average.
SHARD_WORDS = 600_000
#: Different segments of one anchor that one shard takes; windows of larger anchors are counted one by one.
ANCHOR_SEGMENTS = 10_000
#: Words of a text looked at together.
STRETCH = 1 << 17
#: Bytes of a word's hash that travel to the shards.
HASH_BYTES = 6

_BASE, _MIX = 0x9E3779B97F4A7C15 | 1, np.uint64(0xD6E8FEB86659FD93)
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEGMENTS = "doc_id long, key_a long, start long, windows int, anchor long, segment long"
_WORDS = "anchor long, segment long, copies long, windows int, words binary"
_MASKS = "anchor long, segment long, mask long"
_COUNTS = "anchor long, segment long, copies long, bit int, content long"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _packed(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // HASH_BYTES, 8), np.uint8)
    out[:, :HASH_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, HASH_BYTES)
    return out.view("<u8")[:, 0].astype(np.uint64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, np.uint64)
    out[0] = 1
    done, step = 1, base
    while done < count:
        more = min(done, count - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done += more
        step = step * step % (1 << 64)
    return out


def _sums(hashes: np.ndarray) -> np.ndarray:
    """Prefix sums from which the content hash of any stretch follows."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASE, len(hashes)), out=sums[1:])
    return sums


def _content(sums: np.ndarray, back: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    value = (sums[end] - sums[start]) * back[start]
    return (value ^ (value >> np.uint64(32))) * _MIX


def segments_of(hashes: np.ndarray, owner: np.ndarray, window: int, anchor_words: int) -> tuple:
    """Segments of a run of texts, given their word hashes and the text each word belongs to.

    Returns arrays: first word, number of windows, anchor, content hash.
    """
    empty = np.zeros(0, np.int64)
    if len(hashes) < window:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = np.zeros(len(hashes) - anchor_words + 1, np.uint64)
    for i in range(anchor_words):
        grams = grams * np.uint64(_BASE) + hashes[i : i + len(grams)]
    grams = (grams ^ (grams >> np.uint64(31))) * _MIX
    grams ^= grams >> np.uint64(29)
    span = window - anchor_words + 1
    place = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1)
    place += np.arange(len(place))
    whole = np.flatnonzero(owner[: len(place)] == owner[window - 1 :])
    if not len(whole):
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    first = np.flatnonzero(np.diff(place[whole], prepend=-1))
    count = np.diff(np.append(first, len(whole)))
    start = whole[first]
    back = _powers(_INVERSE, len(hashes))
    content = _content(_sums(hashes), back, start, start + count - 1 + window)
    return start, count, grams[place[start]], content


def _stretches(texts: Iterable[str | None]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(text, first word, words) in stretches that overlap by all but one word of a window."""
    for number, text in enumerate(texts):
        words = words_of(text)
        if len(words) >= WINDOW:
            for start in range(0, len(words) - WINDOW + 1, STRETCH):
                yield number, start, words[start : start + STRETCH + WINDOW - 1]


def _runs(texts: Iterable[str | None]) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    run, size = [], 0
    for part in _stretches(texts):
        run.append(part)
        size += len(part[2])
        if size >= STRETCH:
            yield run
            run, size = [], 0
    if run:
        yield run


def _find_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column("doc_id"), batch.column("key_a")
        for run in _runs(values_of(batch.column("text"))):
            hashes = word_hashes([w for _, _, words in run for w in words])
            sizes = np.array([len(words) for _, _, words in run])
            owner = np.repeat(np.arange(len(run)), sizes)
            start, count, anchor, content = segments_of(hashes, owner, WINDOW, ANCHOR_WORDS)
            part = owner[start]
            shift = np.array([first for _, first, _ in run]) - (np.cumsum(sizes) - sizes)
            text = pa.array(np.array([number for number, _, _ in run])[part])
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(text),
                    keys.take(text),
                    pa.array(start + shift[part]),
                    pa.array(count.astype(np.int32)),
                    pa.array(anchor.view(np.int64)),
                    pa.array(content.view(np.int64)),
                ],
                [c.split()[0] for c in _SEGMENTS.split(", ")],
            )


def _segment_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of the segments asked for in each text."""
    names = [c.split()[0] for c in _WORDS.split(", ")]
    for batch in batches:
        for text, segments in zip(values_of(batch.column("text")), values_of(batch.column("wanted"))):
            hashes = word_hashes(words_of(text))
            rows = [
                (
                    s["anchor"],
                    s["segment"],
                    s["copies"],
                    s["windows"],
                    _packed(hashes[s["start"] : s["start"] + s["windows"] - 1 + WINDOW]),
                )
                for s in segments
            ]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names
            )


def repeated_windows(shard: pa.Table) -> pa.Table:
    """Index the segments of a shard, stream them through, report their repeated windows as bit masks."""
    shard = shard.sort_by([("anchor", "ascending"), ("segment", "ascending")])
    sequences = [_unpacked(b) for b in shard.column("words").to_pylist()]
    copies = shard.column("copies").to_numpy()
    windows = shard.column("windows").to_numpy()
    index = FmIndex(sequences, copies, WINDOW)
    length, weight = index.matching_statistics()
    repeated = (length == WINDOW) & (weight > 1)
    first = np.repeat(index.starts, windows)
    bit = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    bits = repeated[first + bit].astype(np.int64) << bit
    masks = np.add.reduceat(bits, np.cumsum(windows) - windows)
    found = pa.table(
        {"anchor": shard.column("anchor"), "segment": shard.column("segment"), "mask": pa.array(masks)}
    )
    return found.filter(pa.array(masks != 0))


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of each segment with the hash of its words."""
    names = [c.split()[0] for c in _COUNTS.split(", ")]
    for batch in batches:
        rows: list[tuple] = []
        for s in batch.to_pylist():
            hashes = _unpacked(s["words"])
            start = np.arange(s["windows"])
            content = _content(_sums(hashes), _powers(_INVERSE, len(hashes)), start, start + WINDOW)
            rows += [
                (s["anchor"], s["segment"], s["copies"], bit, value)
                for bit, value in enumerate(content.view(np.int64).tolist())
            ]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _counted_one_by_one(segments: DataFrame) -> DataFrame:
    """Masks for segments of very frequent anchors: windows are counted by content, combined before they shuffle."""
    single = stored(segments.mapInArrow(_single_windows, _COUNTS), "windows")
    repeated = (
        single.groupBy("anchor", "content").agg(F.sum("copies").alias("n")).where("n > 1").drop("n")
    )
    return (
        single.join(repeated, ["anchor", "content"], "left_semi")
        .groupBy("anchor", "segment")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))
    )


def repeats(
    documents: DataFrame, shard_words: int = SHARD_WORDS, anchor_segments: int = ANCHOR_SEGMENTS
) -> DataFrame:
    """Rows (doc_id, key_a, removals) for the texts that have repeated windows.

    removals lists structs (start, mask): bit b set means the window at word start + b is repeated.
    """
    source = documents.where("text is not null").select("doc_id", "text", text_key()[0])
    found = stored(source.mapInArrow(_find_segments, _SEGMENTS), "segments")
    # Stored, so that adaptive execution can split the join below at frequent anchors.
    often = stored(
        found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "anchors"
    )
    shared = stored(found.join(often, "anchor", "left_semi"), "shared-segments")

    place = F.min(F.struct("doc_id", "key_a", "start")).alias("place")
    different = stored(
        shared.groupBy("anchor", "segment").agg(
            F.count("*").alias("copies"), F.min("windows").alias("windows"), place
        ),
        "different-segments",
    )
    size = F.sum(F.col("windows") + F.lit(WINDOW))
    shards = max(1, -(-(different.agg(size).first()[0] or 0) // shard_words))
    # At most the number of segments / anchor_segments anchors.
    crowded = stored(
        different.groupBy("anchor")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > anchor_segments)
        .select("anchor"),
        "crowded-anchors",
    )
    keyed = documents.where("text is not null").select("doc_id", "text", text_key()[0])

    def words_of_segments(segments: DataFrame) -> DataFrame:
        segment = F.struct("anchor", "segment", "copies", "windows", F.col("place.start").alias("start"))
        wanted = segments.groupBy(
            F.col("place.doc_id").alias("of_doc"), F.col("place.key_a").alias("of_key")
        ).agg(F.collect_list(segment).alias("wanted"))
        here = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("key_a") == F.col("of_key"))
        first = F.row_number().over(Window.partitionBy("doc_id", "key_a").orderBy("doc_id", "key_a"))
        # Texts stream past a hash table of the few bytes wanted of each, instead of being sorted.
        texts = keyed.join(wanted.hint("shuffle_hash"), here).withColumn("copy", first).where("copy = 1")
        return texts.select("text", "wanted").mapInArrow(_segment_words, _WORDS)

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    indexed = (
        words_of_segments(different.join(crowded, "anchor", "left_anti"))
        .select("*", shard)
        .groupBy("shard")
        .applyInArrow(lambda table: repeated_windows(table), _MASKS)
    )
    masks = stored(indexed, "masks")
    if crowded.count():
        single = words_of_segments(different.join(crowded, "anchor", "left_semi"))
        masks = masks.unionAll(stored(_counted_one_by_one(single), "masks"))
    return (
        shared.join(masks, ["anchor", "segment"])
        .groupBy("doc_id", "key_a")
        .agg(F.collect_set(F.struct("start", "mask")).alias("removals"))
    )


def with_removals(documents: DataFrame, found: DataFrame) -> DataFrame:
    """All rows of documents, each as a struct row, with the removals of its text (null if none).

    Removals are one row a text, a few bytes for each repeated segment, and make a hash table in each partition that
    texts stream past: whole rows are shuffled, but not sorted.
    """
    found = found.select(F.col("doc_id").alias("of_doc"), F.col("key_a").alias("of_key"), "removals")
    keyed = documents.select(whole_row(documents), "doc_id", text_key()[0])
    here = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("key_a") == F.col("of_key"))
    return keyed.join(found.hint("shuffle_hash"), here, "left").select("row", "removals")


def kept_words(text: str | None, removals: list | None) -> tuple[int, list[bytes]]:
    """Number of words of a text, and those outside its repeated windows."""
    words = words_of(text)
    if removals is None or not len(removals):
        return len(words), words
    edges = np.zeros(len(words) + 1, np.int32)
    for r in removals:
        bits = np.flatnonzero((r["mask"] >> np.arange(63)) & 1) + r["start"]
        edges[bits] += 1
        edges[bits + WINDOW] -= 1
    keep = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    return len(words), [words[i] for i in keep.tolist()]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        texts, removals = values_of(batch.column("text")), values_of(batch.column("removals"))
        for doc_id, text, removal in zip(batch.column("doc_id").to_pylist(), texts, removals):
            count, kept = kept_words(text, removal)
            digest = hashlib.sha256(b" ".join(kept)).hexdigest()
            rows.append((doc_id, count, count - len(kept), digest))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            [c.split()[0] for c in _RESULT.split(", ")],
        )


def remove_repeats(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256. Null and short texts lose nothing."""
    documents = documents.select("doc_id", "text")
    judged = with_removals(documents, repeats(documents))
    return judged.select("row.doc_id", "row.text", "removals").mapInArrow(_digests, _RESULT)


@F.pandas_udf(StringType())
def _kept_text(texts: pd.Series, removals: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if t is None else b" ".join(kept_words(t, r)[1]).decode("utf-8", "replace")
            for t, r in zip(texts, removals)
        ]
    )


def cut_repeats(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated windows are cut out of the texts; texts that lose all words go.

    Texts without repeats keep their white space; the others' remaining words are joined by one space.
    """
    judged = with_removals(documents, repeats(documents))
    has = F.col("removals").isNotNull()
    text = F.when(has, _kept_text("row.text", "removals")).otherwise(F.col("row.text")).alias("text")
    cut = judged.select("row", has.alias("cut"), text).where(~F.col("cut") | (F.col("text") != ""))
    columns = {c: F.col(f"row.`{c}`") for c in documents.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("cut"), F.length("text")).otherwise(columns["n_chars"])
    return cut.select(*[value.alias(c) for c, value in columns.items()])


def op10_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
