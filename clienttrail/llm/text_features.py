"""Sparse hashed word features of whole texts, and labelled samples of bounded size."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clienttrail.llm.common import smallest_of_each, stored, text_key, values_of, words_of

#: Features must occur in at least so many rows of the training sample and tell grades apart by so many
#: standard errors of their log odds; each is known by 63 bits of its hash.
LEAST_ROWS, LEAST_SIGNAL = 3, 2.5
#: Characters of word beginnings that are features beside the words.
BEGINNINGS = (4, 5)
_EDGES = ".,;:!?\"'()[]"

Rows = list[tuple[np.ndarray, np.ndarray]]


def word_features(
    text: str | None, beginnings: tuple[int, ...] = BEGINNINGS
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (rising) and values of a text's words and word beginnings: log counts scaled to length one.

    Words are lower case and without punctuation at their ends.
    """
    counts = Counter((text or "").lower().split())
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0)
    words = [w.strip(_EDGES) for w in counts]
    names = list(words)
    for size in beginnings:
        names += [f"{size}{w[:size]}" for w in words]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(n) >> 1 for n in names), np.int64, len(names))
    index, place = np.unique(hashes, return_inverse=True)
    times = np.tile(np.fromiter(counts.values(), float, len(counts)), 1 + len(beginnings))
    value = np.log1p(np.bincount(place, times))
    return index, value / np.sqrt((value**2).sum())


def telling(present: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which features tell some grade from the others.

    present: rows of each grade (first axis) that have each feature; rows: rows of each grade.
    """
    rows = rows[:, None]
    inside, outside = present + 0.5, present.sum(axis=0) - present + 0.5
    here, there = rows + 1 - inside, rows.sum() - rows + 1 - outside
    odds = np.log(inside * there / (outside * here))
    error = np.sqrt(1 / inside + 1 / outside + 1 / here + 1 / there)
    often = present.sum(axis=0) >= LEAST_ROWS
    return often & (np.abs(odds) >= LEAST_SIGNAL * error).any(axis=0)


def telling_features(rows: Rows, grades: np.ndarray) -> np.ndarray:
    """The hashes, rising, of the features of a labelled sample that are telling."""
    vocabulary = np.unique(np.concatenate([i for i, _ in rows]))
    features = SparseRows(rows, vocabulary)
    kinds = np.unique(grades)
    present = [
        np.bincount(features.index[grades[features.row] == k], minlength=len(vocabulary)) for k in kinds
    ]
    return vocabulary[telling(np.stack(present), np.array([(grades == k).sum() for k in kinds]))]


class SparseRows:
    """Rows over a vocabulary: products with a matrix, and with its transpose."""

    def __init__(self, rows: Rows, vocabulary: np.ndarray):
        sizes = [len(i) for i, _ in rows]
        hashes = np.concatenate([i for i, _ in rows] or [np.zeros(0, np.int64)])
        values = np.concatenate([v for _, v in rows] or [np.zeros(0)])
        place = np.searchsorted(vocabulary, hashes)
        known = place < len(vocabulary)
        known[known] = vocabulary[place[known]] == hashes[known]
        self.count, self.features = len(rows), len(vocabulary)
        self.index, self.value = place[known], values[known]
        self.row = np.repeat(np.arange(len(rows)), sizes)[known]

    def times(self, weights: np.ndarray) -> np.ndarray:
        """(rows, k) from weights (features, k)."""
        columns = [
            np.bincount(self.row, self.value * w[self.index], minlength=self.count) for w in weights.T
        ]
        return np.column_stack(columns)

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        """(features, k) from values (rows, k)."""
        columns = [
            np.bincount(self.index, self.value * v[self.row], minlength=self.features)
            for v in values.T
        ]
        return np.column_stack(columns)


def minimize(gradient, parameters: list[np.ndarray], steps: int, rate: float) -> list[np.ndarray]:
    """Adam from zero moments; gradient(parameters) returns a list of the same shapes."""
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    for t in range(1, steps + 1):
        for p, g, m, v in zip(parameters, gradient(parameters), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return parameters


def _features(beginnings: tuple[int, ...]):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [word_features(t, beginnings) for t in values_of(batch.column("text"))]
            index = pa.array([i for i, _ in rows], pa.list_(pa.int64()))
            value = pa.array([v for _, v in rows], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), index, value], ["grade", "index", "value"]
            )

    return features


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    grade: Column,
    rows_of_each: int,
    beginnings: tuple[int, ...] = BEGINNINGS,
) -> tuple[np.ndarray, Rows, dict[int, int]]:
    """At most rows_of_each labelled documents of each grade, by hash; also how many labels have each.

    grade is a column over labels (a small whole number; null: not used). Labels are ranked by ids alone
    and texts are read for the chosen ids. Features are counted by grade on the cluster; the driver gets
    those that occur often enough, and of each row the telling ones. Several labels of one document: the
    largest grade. Documents without text have no features.
    """
    graded = labels.select("doc_id", grade.cast("int").alias("grade"))
    graded = graded.where("doc_id is not null and grade is not null")
    graded = graded.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    counts = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}
    hashed = graded.withColumn("hash", F.xxhash64("doc_id"))
    chosen = smallest_of_each(hashed, "grade", rows_of_each, "doc_id").drop("hash")
    # At most rows_of_each ids for each grade; one text for each id.
    found = (
        documents.where("text is not null")
        .select("doc_id", "text", *text_key())
        .join(F.broadcast(chosen), "doc_id")
        .withColumn(
            "copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("key_a", "key_b"))
        )
        .where("copy = 1")
        .select("text", "grade")
    )
    kinds = "grade int, index array<long>, value array<double>"
    features = stored(found.mapInArrow(_features(beginnings), kinds), "features")
    grades = sorted(counts)
    present = (
        features.select("grade", F.explode("index").alias("feature"))
        .groupBy("feature")
        .agg(*[F.count_if(F.col("grade") == g).alias(f"g{g}") for g in grades], F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_ROWS)
    )
    if not grades:
        return np.zeros(0, np.int64), [], counts
    table = present.drop("n").orderBy("feature").toArrow()
    rows = {r["grade"]: r["count"] for r in features.groupBy("grade").count().collect()}
    matrix = np.stack([table.column(f"g{g}").to_numpy() for g in grades])
    vocabulary = table.column("feature").to_numpy()[
        telling(matrix, np.array([rows.get(g, 0) for g in grades]))
    ]
    del table, matrix
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch.column("index").to_pylist(), batch.column("value").to_pylist()))
            own = [np.isin(i, shared.value, assume_unique=True) for i, _ in pairs]
            index = [np.array(i, np.int64)[k] for (i, _), k in zip(pairs, own)]
            value = [np.array(v)[k] for (_, v), k in zip(pairs, own)]
            arrays = [batch.column("grade")]
            arrays += [pa.array(index, pa.list_(pa.int64())), pa.array(value, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["grade", "index", "value"])

    # In an order of its own, whatever the tasks' order. The rows are views of the collected columns.
    sample = features.mapInArrow(known, kinds).orderBy("grade", F.xxhash64("index", "value")).toArrow()
    index, value = (sample.column(c).combine_chunks() for c in ("index", "value"))
    ends = np.cumsum(index.value_lengths().to_numpy(zero_copy_only=False))
    index, value = (c.flatten().to_numpy(zero_copy_only=False) for c in (index, value))
    out = [(index[i:j], value[i:j]) for i, j in zip(np.append(0, ends[:-1]).astype(int), ends)]
    return sample.column("grade").to_numpy().astype(np.int64), out, counts


def words_in(text: str | None) -> int:
    return len(words_of(text))
