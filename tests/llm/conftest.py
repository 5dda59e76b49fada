from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source); extra columns bear clashing names."""

    def make(rows, extra=True):
        full = []
        for doc_id, text, *rest in rows:
            lang, source = (*rest, None, None)[:2]
            row = (doc_id, text, lang, source, None if text is None else len(text))
            full.append(row + (7, "x", 1, "y") if extra else row)
        kinds = KINDS + (", key_a long, row string, copy int, removals string" if extra else "")
        return spark.createDataFrame(full, kinds)

    return make


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")
