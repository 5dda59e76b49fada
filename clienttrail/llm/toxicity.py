"""Severity of toxic texts by cumulative-link ordinal regression on sparse text features.

P(grade >= k) = sigmoid(w.x - t_k), with one weight vector for all thresholds t_1 < t_2 < ... . Grades of
the training rows come from the labels table: 0 for documents labelled not toxic; the toxic ones are
ordered by the weight of their features that speak for toxicity in the training rows, the lower half
being grade 1 and the upper half grade 2. Severity is the expected grade.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clienttrail.llm.common import read_table, values_of
from clienttrail.llm.text_features import (
    Rows,
    SparseRows,
    labelled_sample,
    minimize,
    telling_features,
    word_features,
)

GRADES = 3
#: Labelled documents of either label that the model learns from at most.
TRAIN_ROWS = 4000
#: Texts whose probability of grade 1 or more reaches this are called toxic.
TOXIC_FROM = 0.4
#: Log odds of occurring in toxic rows from which a feature speaks for toxicity.
SPEAKS_FROM = 3.0
PENALTY = 2e-6

_RESULT = "doc_id long, severity double, grade int, toxic boolean"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class OrdinalModel:
    """A vocabulary, weights shared by all thresholds, and the rising thresholds."""

    def __init__(self, vocabulary: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.vocabulary, self.weights, self.thresholds = vocabulary, weights, thresholds

    def at_least(self, rows: Rows) -> np.ndarray:
        """P(grade >= k) for each row and k = 1, 2, ..."""
        score = SparseRows(rows, self.vocabulary).times(self.weights[:, None])
        return _sigmoid(score - self.thresholds)

    @classmethod
    def fit(cls, rows: Rows, grades: np.ndarray) -> OrdinalModel:
        """Maximum likelihood with a small ridge penalty."""
        vocabulary = telling_features(rows, grades)
        features = SparseRows(rows, vocabulary)
        weight = 1 / len(grades)

        def gradient(parameters: list[np.ndarray]) -> list[np.ndarray]:
            w, first, steps = parameters
            thresholds = np.concatenate([first, first + np.cumsum(np.exp(steps))])
            score = features.times(w[:, None])
            above = np.column_stack(
                [np.ones(len(grades)), _sigmoid(score - thresholds), np.zeros(len(grades))]
            )
            rise = above * (1 - above)
            each = np.arange(len(grades))
            chance = np.maximum(above[each, grades] - above[each, grades + 1], 1e-9)
            scale = weight / chance
            by_score = -scale * (rise[each, grades] - rise[each, grades + 1])
            # A threshold lowers the chance to be above it.
            by_threshold = np.zeros(GRADES + 1)
            np.add.at(by_threshold, grades, scale * rise[each, grades])
            np.add.at(by_threshold, grades + 1, -scale * rise[each, grades + 1])
            by_threshold = by_threshold[1:GRADES]
            by_step = np.array(
                [by_threshold[k + 1 :].sum() * np.exp(steps[k]) for k in range(GRADES - 2)]
            )
            by_weight = features.transposed_times(by_score[:, None])[:, 0] + PENALTY * w
            return [by_weight, np.array([by_threshold.sum()]), by_step]

        start = [np.zeros(len(vocabulary)), np.zeros(1), np.zeros(GRADES - 2)]
        w, first, steps = minimize(gradient, start, steps=250, rate=0.2)
        return cls(vocabulary, w, np.concatenate([first, first + np.cumsum(np.exp(steps))]))


def grades_of(rows: Rows, toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 of labelled rows; see the module's text. Equal shares have equal grades."""
    vocabulary = telling_features(rows, toxic)
    features = SparseRows(rows, vocabulary)
    present = np.stack(
        [np.bincount(features.index[toxic[features.row] == k], minlength=len(vocabulary)) for k in (0, 1)]
    )
    totals = np.maximum(np.bincount(toxic, minlength=2), 1)[:, None]
    odds = (present + 0.5) / (totals - present + 0.5)
    speaks = (np.log(odds[1] / odds[0]) >= SPEAKS_FROM).astype(float)
    share = features.times(speaks[:, None])[:, 0]
    middle = np.median(share[toxic == 1]) if toxic.any() else 0.0
    return np.where(toxic == 0, 0, np.where(share <= middle, 1, 2))


def fit_severity(documents: DataFrame, labels: DataFrame) -> OrdinalModel | None:
    """Learn from a bounded sample of the labelled documents; None unless both labels occur."""
    toxic, rows, _ = labelled_sample(documents, labels, F.expr("cast(toxic = 1 as int)"), TRAIN_ROWS)
    if len(np.unique(toxic)) < 2:
        return None
    return OrdinalModel.fit(rows, grades_of(rows, toxic))


def _judge(shared):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = [word_features(t) for t in values_of(batch.column("text"))]
            above = model.at_least(rows) if model else np.zeros((len(rows), GRADES - 1))
            wordless = np.array([len(i) == 0 for i, _ in rows], bool)
            above[wordless] = 0
            chances = -np.diff(np.column_stack([np.ones(len(rows)), above, np.zeros(len(rows))]), axis=1)
            arrays = [
                batch.column("doc_id"),
                pa.array(above.sum(axis=1)),
                pa.array(chances.argmax(axis=1).astype(np.int32)),
                pa.array(above[:, 0] >= TOXIC_FROM),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "severity", "grade", "toxic"])

    return judge


def score_severity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, severity (expected grade, 0 to 2), grade (the likeliest), toxic.

    Texts that are null or have no word have severity 0. Without documents of both labels no text is
    toxic. Repeated rows are judged alike.
    """
    model = fit_severity(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return documents.select("doc_id", "text").mapInArrow(_judge(shared), _RESULT)


def op8_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_severity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
