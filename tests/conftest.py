from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from clienttrail.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
    )
    session = build_session(builder)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_path(tmp_path_factory):
    from fixtures import RAW_CSV

    path = tmp_path_factory.mktemp("raw") / "events.csv"
    path.write_text(RAW_CSV)
    return str(path)


@pytest.fixture(scope="session")
def raw(spark, raw_path):
    from clienttrail.sources import read_raw_csv

    return read_raw_csv(spark, raw_path)


@pytest.fixture(scope="session")
def staged(raw):
    from clienttrail.operators.staging import stage_events

    return stage_events(raw).cache()
