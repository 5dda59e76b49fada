"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams of one to four characters (a blended
spectrum) that both contain, over the root of the product of their numbers of n-grams. Landmarks drawn
from the training rows span a Nyström approximation of it, and one-versus-rest kernel ridge regression
is solved on that span. With P the n-gram presence of a batch of texts and P_L that of the landmarks,
the scores K(batch, landmarks) A equal P (P_L' A), so a batch is scored by one sparse product with the
precomputed P_L' A. N-grams are hashed to 2^18 places.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clienttrail.llm.common import few_rows, read_table, smallest_of_each, text_key, values_of

LONGEST = 4
PLACES_LOG2 = 18
#: Training rows and landmarks of each language at most, landmarks in all, and languages learned (the
#: most frequent ones).
TRAIN_ROWS, LANDMARKS, ALL_LANDMARKS, LANGUAGES = 300, 40, 320, 128
RIDGE = 1e-3
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
#: Texts that no language's regression gives at least this score are rejected by the pipeline. A text that
#: resembles no landmark scores about 0.5; the margin is set on held-out rows.
MIN_SCORE = 0.525
#: Characters whose n-grams are hashed at a time.
_STRETCH = 1 << 18
_SPACE = re.compile(r"\s+")
_SCORED = "lang_pred string, score double"


def gram_places(text: str) -> np.ndarray:
    """The distinct places of a text's n-grams, from all of it; lower case, white space as one space."""
    text = " " + _SPACE.sub(" ", text.lower()).strip() + " "
    seen = np.zeros(1 << PLACES_LOG2, bool)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    for start in range(0, len(points), _STRETCH):
        part = points[start : start + _STRETCH + LONGEST - 1].astype(np.uint64)
        value = np.zeros(len(part), np.uint64)
        for n in range(1, LONGEST + 1):
            if len(part) < n:
                break
            value = value[: len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1 :] + np.uint64(n)
            mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            seen[mixed >> np.uint64(64 - PLACES_LOG2)] = True
    return np.flatnonzero(seen)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class StringKernelModel:
    """languages, and weights of shape (places, languages): what scoring a batch needs."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    @classmethod
    def fit(cls, grams: list[np.ndarray], languages: list[str], landmarks: int = LANDMARKS) -> StringKernelModel:
        """gram_places() of the rows of each language in the order given; its first rows are its landmarks."""
        names = sorted(set(languages))
        landmarks = max(1, min(landmarks, ALL_LANDMARKS // len(names)))
        chosen: list[int] = []
        for name in names:
            chosen += [i for i, own in enumerate(languages) if own == name][:landmarks]
        presence = np.zeros((len(chosen), 1 << PLACES_LOG2), np.float32)
        for row, i in enumerate(chosen):
            presence[row, grams[i]] = 1 / np.sqrt(max(1, len(grams[i])))
        kernel = np.stack(
            [presence[:, g].sum(axis=1) / np.sqrt(max(1, len(g))) for g in grams]
        ).astype(float)
        among = kernel[chosen]
        targets = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
        # Each language weighs the same, however many rows it has.
        weight = np.array([1 / languages.count(own) for own in languages])[:, None]
        left = kernel.T @ (weight * kernel) + RIDGE * len(names) * (among + 1e-6 * np.eye(len(chosen)))
        alpha = np.linalg.solve(left, kernel.T @ (weight * targets))
        return cls(names, (presence.T @ alpha.astype(np.float32)).astype(np.float32))

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row of regression values per text: the presence of its n-grams times the weights."""
        grams = [gram_places(t) for t in texts]
        sizes = np.array([len(g) for g in grams])
        sums = np.add.reduceat(
            self.weights[np.concatenate(grams)], np.cumsum(sizes) - sizes, axis=0, dtype=np.float64
        )
        return sums / np.sqrt(sizes)[:, None]

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred and score (0 to 1: the best regression value, -1 to 1, halved and moved)."""
        out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0}, index=range(len(texts)))
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for start in range(0, len(known), 64):
            rows = known[start : start + 64]
            values = self.scores([texts[i] for i in rows])
            out.loc[rows, "lang_pred"] = [self.languages[k] for k in values.argmax(axis=1)]
            out.loc[rows, "score"] = np.clip((values.max(axis=1) + 1) / 2, 0, 1)
        return out


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, text in enumerate(values_of(batch.column("text"))):
            if has_letter(text):
                places = pa.array([gram_places(text).astype(np.int32)], pa.list_(pa.int32()))
                some = batch.slice(number, 1)
                arrays = [some.column(c) for c in ("lang", "hash", "doc_id", "key_a")]
                yield pa.RecordBatch.from_arrays([*arrays, places], ["lang", "hash", "doc_id", "key_a", "places"])


def training_rows(documents: DataFrame, per_language: int = TRAIN_ROWS) -> tuple[list[str], list[np.ndarray]]:
    """Languages and n-gram places of at most per_language rows of each of at most LANGUAGES languages.

    Rows are chosen by hash, from ids and hashes alone, and texts are read for those rows only. The driver gets
    their distinct places, 2^18 at most for each row, and no text.
    """
    labelled = documents.where(
        "text is not null and lang is not null and doc_id is not null"
    ).where(fold() != HELD_OUT)
    frequent = (
        labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    )
    labelled = labelled.join(F.broadcast(frequent), "lang")
    keyed = labelled.select("lang", "doc_id", *text_key()).withColumn(
        "hash", F.xxhash64("doc_id", "key_a")
    )
    few = smallest_of_each(keyed, "lang", per_language, "doc_id", "key_a", "key_b").distinct()
    # At most per_language * LANGUAGES rows of a few bytes each.
    found = (
        labelled.select("lang", "doc_id", "text", *text_key())
        .join(F.broadcast(few), ["lang", "doc_id", "key_a", "key_b"])
        .mapInArrow(_places, "lang string, hash long, doc_id long, key_a long, places array<int>")
        .dropDuplicates(["lang", "doc_id", "key_a"])
        .orderBy("lang", "hash", "doc_id", "key_a")
        .select("lang", "places")
        .toArrow()
    )
    places = found.column("places")
    return found.column("lang").to_pylist(), [places[i].values.to_numpy() for i in range(len(places))]


def fit_languages(documents: DataFrame) -> StringKernelModel:
    """Learn from text and lang of the rows that are not held out; without such rows every text is und."""
    languages, places = training_rows(documents)
    if not languages:
        return StringKernelModel([], np.zeros((1 << PLACES_LOG2, 0), np.float32))
    return StringKernelModel.fit(places, languages)


def predicted(documents: DataFrame, model: StringKernelModel) -> DataFrame:
    """doc_id, lang_pred and score of every row. The model, places x languages floats, is broadcast."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in few_rows(batch):
                found = shared.value.predict(list(values_of(some.column("text"))))
                arrays = [some.column("doc_id"), pa.array(found["lang_pred"]), pa.array(found["score"])]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score"])

    return documents.select("doc_id", "text").mapInArrow(predict, f"doc_id {_id_type(documents)}, {_SCORED}")


def _id_type(documents: DataFrame) -> str:
    return documents.schema["doc_id"].dataType.simpleString()


def keep_known_languages(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: null texts, texts without a letter, and texts no language's regression claims, go.

    Rows pass through whole, whatever their other columns, and repeated rows stay.
    """
    shared = spark.sparkContext.broadcast(fit_languages(documents))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in few_rows(batch):
                found = shared.value.predict(list(values_of(some.column("text"))))
                known = (found["lang_pred"] != UNKNOWN) & (found["score"] >= MIN_SCORE)
                yield some.filter(pa.array(known.to_numpy()))

    return documents.mapInArrow(keep, documents.schema)


def op9_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's language; a null text, or one without a letter, is `und` with score 0. Texts are read whole, of
    any length; equal best values go to the language first in order; repeated rows are each judged; without rows
    to learn from every text is `und`. A null doc_id is not held out and not learnt from."""
    documents = read_table(spark, sf_dir, "documents")
    found = predicted(documents, fit_languages(documents))
    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
