"""Spelling variants: generated edits are probed against Bloom filters, positives joined to the vocabulary.

The vocabulary is counted first. Its words are put into blocked Bloom filters, one for each word length,
which are broadcast; a block is one 64-bit word. Their bytes are bounded by a parameter: a vocabulary that
is too large for it only raises the share of false positives. Each word then generates its edits, all as
hashes derived from the hashes of its beginnings and ends, and only edits that a filter knows become text
and are shuffled to an exact join with the vocabulary. Nearness is symmetric, so each pair is generated
once: deletions from the longer word, replacements from the word with the smaller code point.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clienttrail.llm.common import read_table, stored

MIN_LENGTH, MIN_COUNT = 7, 2
#: One occurrence in so many loses a code point before words are counted.
DAMAGE = 31
#: A form is so many times as frequent as its variant at least.
FORM_RATIO = 10
#: Filters: bits a word, bits set for each, 64-bit blocks of all lengths together, lengths that share the last.
WORD_BITS, PROBES, MAX_BLOCKS, LONG_WORD = 16, 4, 1 << 21, 64
#: Different words counted by a task before it hands them on, and hashes probed at a time.
HELD_WORDS, PROBED = 200_000, 1 << 20

# Letters are bytes of Latin-1: A-Z lower-cased, the others as they are; anything else is a space.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def runs_of(text: str | None) -> list[bytes]:
    """Lower-cased maximal runs of letters as Latin-1, one byte a code point."""
    if text is None:
        return []
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def damaged(run: bytes, salt: int, damage: int = DAMAGE) -> bytes:
    """The run, one in `damage` without a code point; salt is the CRC of `<doc_id>:`."""
    check = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), salt)
    if check % damage:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def _counting(min_length: int, damage: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def handed() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                salt = zlib.crc32(f"{'' if doc_id.as_py() is None else doc_id.as_py()}:".encode())
                runs = Counter([r for r in runs_of(text.as_py()) if len(r) >= min_length])
                for run, n in runs.items():
                    word = damaged(run, salt, damage)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield handed()
                    held.clear()
        if held:
            yield handed()

    return count


def vocabulary(
    documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int = DAMAGE
) -> DataFrame:
    """Rows (word, n): words of at least min_length code points that occur min_count times or more."""
    counted = documents.select("doc_id", "text").mapInArrow(_counting(min_length, damage), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits of the given ones."""
    value = hashes ^ (hashes >> np.uint64(31))
    value = value * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    value = value * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(32))


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(length, _BASE, np.uint64)]))


def _masks(mixed: np.ndarray) -> np.ndarray:
    """The bits of its block that a word sets."""
    mask = np.zeros(mixed.shape, np.uint64)
    for probe in range(PROBES):
        mask |= np.uint64(1) << ((mixed >> np.uint64(6 * probe)) & np.uint64(63))
    return mask


class Filters:
    """Blocked Bloom filters, one for each length; those of LONG_WORD and longer share the last."""

    def __init__(self, counts: dict[int, int], max_blocks: int = MAX_BLOCKS) -> None:
        wanted = {k: n * WORD_BITS // 64 + 1 for k, n in counts.items()}
        share = min(1.0, max_blocks / max(1, sum(wanted.values())))
        sizes = np.zeros(LONG_WORD + 1, np.uint64)
        for k, n in wanted.items():
            sizes[k] = max(1, int(n * share))
        self.sizes = sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64)
        self.blocks = np.zeros(int(sizes.sum()), np.uint64)

    def places(self, mixed: np.ndarray, length: int) -> np.ndarray:
        """The block of each hash of words of one length, of a length that has words."""
        length = min(length, LONG_WORD)
        return self.starts[length] + ((mixed >> np.uint64(24)) % self.sizes[length])

    def knows(self, hashes: np.ndarray, length: int) -> np.ndarray:
        if not self.sizes[min(length, LONG_WORD)]:
            return np.zeros(hashes.shape, bool)
        mixed = _mixed(hashes)
        masks = _masks(mixed)
        return (self.blocks[self.places(mixed, length)] & masks) == masks


def _by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length its places in the list and the words as rows of bytes, in bounded pieces."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        step = max(1, PROBED // int(length))
        for start in range(0, len(at), step):
            some = at[start : start + step]
            rows = np.frombuffer(b"".join([words[i] for i in some]), np.uint8).reshape(len(some), length)
            yield int(length), some, rows


def _hashes(rows: np.ndarray) -> np.ndarray:
    return (rows.astype(np.uint64) * _powers(rows.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def _latin(batch: pa.RecordBatch) -> list[bytes]:
    return [w.encode("latin-1") for w in batch.column("word").to_pylist()]


def _filing(filters):
    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, rows in _by_length(_latin(batch)):
                mixed = _mixed(_hashes(rows))
                places = filters.value.places(mixed, length).astype(np.int64)
                masks = _masks(mixed).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(masks)], ["place", "mask"])

    return file


def filters_of(words: DataFrame, max_blocks: int = MAX_BLOCKS) -> Filters:
    """The filters of a vocabulary. The driver sees counts of at most 64 lengths and max_blocks blocks."""
    length = F.least(F.length("word"), F.lit(LONG_WORD))
    filters = Filters(dict(words.groupBy(length).count().collect()), max_blocks)
    # Only the layout travels here: the filters are empty.
    layout = words.sparkSession.sparkContext.broadcast(filters)
    filed = words.select("word").mapInArrow(_filing(layout), "place long, mask long")
    merged = filed.groupBy("place").agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    full = Filters.__new__(Filters)
    full.sizes, full.starts, full.blocks = filters.sizes, filters.starts, np.zeros_like(filters.blocks)
    full.blocks[merged.column("place").to_numpy()] = merged.column("mask").to_numpy().view(np.uint64)
    return full


def _edits(rows: np.ndarray, letters: np.ndarray, filters: Filters, shortest: int):
    """(row, position, letter) of every edit a filter knows; letter 0 stands for a deletion."""
    count, length = rows.shape
    powers = _powers(length)
    values = rows.astype(np.uint64) * powers[:-1]
    whole = values.sum(axis=1, dtype=np.uint64)
    known = Filters.knows
    if length > shortest:
        # What follows a deleted letter moves one place down: its hash is that of the next letters, each
        # with the power before its own.
        moved = rows[:, 1:].astype(np.uint64) * powers[: length - 1]
        ahead = np.cumsum(values, axis=1, dtype=np.uint64) - values
        behind = np.concatenate([np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], np.zeros((count, 1), np.uint64)], axis=1)
        # Deleting any one of equal neighbours gives the same word: the last of them stands for all.
        last = np.concatenate([rows[:, :-1] != rows[:, 1:], np.ones((count, 1), bool)], axis=1)
        found = np.flatnonzero(last & known(filters, ahead + behind, length - 1))
        yield found // length, found % length, np.zeros(len(found), np.uint8)
    step = max(1, PROBED // max(1, count * len(letters)))
    for start in range(0, length, step):
        part = rows[:, start : start + step, None]
        rise = (letters.astype(np.uint64) - part.astype(np.uint64)) * powers[start : start + part.shape[1], None]
        row, at, letter = np.nonzero((letters > part) & known(filters, whole[:, None, None] + rise, length))
        yield row, at + start, letters[letter]


def _probing(filters, letters: np.ndarray, shortest: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = _latin(batch), batch.column("n").to_numpy()
            for length, some, rows in _by_length(words):
                step = max(1, PROBED // (length * max(1, len(letters))))
                for start in range(0, len(rows), step):
                    for row, at, letter in _edits(rows[start : start + step], letters, filters.value, shortest):
                        origin = some[start + row]
                        edits = [
                            words[i][:j] + (bytes([c]) if c else b"") + words[i][j + 1 :]
                            for i, j, c in zip(origin.tolist(), at.tolist(), letter.tolist())
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([words[i].decode("latin-1") for i in origin], pa.string()),
                                pa.array(counts[origin]),
                                pa.array([e.decode("latin-1") for e in edits], pa.string()),
                            ],
                            ["of_word", "of_n", "edit"],
                        )

    return probe


def near_pairs(words: DataFrame, shortest: int = MIN_LENGTH, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Rows (word, near, near_n), both ways, for all pairs of words (word, n) one edit apart."""
    filters = words.sparkSession.sparkContext.broadcast(filters_of(words, max_blocks))
    # At most 90 letters.
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    letters = np.array(sorted(ord(c) for (c,) in letters.where("letter <> ''").collect()), np.uint8)
    probes = words.mapInArrow(_probing(filters, letters, shortest), "of_word string, of_n long, edit string")
    exact = probes.join(words, F.col("edit") == F.col("word"))
    ways = F.array(
        F.struct(F.col("of_word").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
        F.struct("word", F.col("of_word").alias("near"), F.col("of_n").alias("near_n")),
    )
    return exact.select(F.inline(ways))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """Rows (word, root) for every word with a form, by pointers that double their reach each round.

    Counts rise tenfold from a word to its form, so the largest count bounds the length of a chain.
    """
    reach, chain = 1, int(log10(max(1, most)) / log10(FORM_RATIO)) + 1
    roots = forms.select("word", F.col("form").alias("root"))
    while reach < chain:
        roots = stored(roots, "spelling-roots")
        ahead = roots.select(F.col("word").alias("at"), F.col("root").alias("next"))
        joined = roots.join(ahead, F.col("root") == F.col("at"), "left")
        roots = joined.select("word", F.coalesce("next", "root").alias("root"))
        reach *= 2
    return roots


def spelling_forms(
    documents: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    damage: int = DAMAGE,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Near words differ by one inserted, deleted or replaced code point; the form is the most frequent of them
    (ties: the smallest) if it is ten times as frequent; the root ends the chain of forms.

    A null or empty text has no words, a null doc_id counts as an empty one. Texts are read whole, one at a
    time; a word may be as long as a text. Repeated rows count again. Other columns are not read, whatever
    their names. No words give no rows.
    """
    words = stored(vocabulary(documents, min_length, min_count, damage), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    pairs = near_pairs(words, min_length, max_blocks)
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.less")
    apt = form_n >= FORM_RATIO * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(apt, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(apt, form_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(judged.where("form is not null").select("word", "form"), most)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(read_table(spark, sf_dir, "documents"))
