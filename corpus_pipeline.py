"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clienttrail.llm.common import read_table, shared_dir
from clienttrail.llm.langid import keep_known_languages
from clienttrail.llm.mixing import mix_stage
from clienttrail.llm.packing import pack_stage
from clienttrail.llm.simhash import keep_one_of_each_group
from clienttrail.llm.substring import cut_repeats

STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("repeated_passages", cut_repeats),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

#: Trained models and an FM-index have no SQL counterpart; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table. Each result is written as Parquet and read again."""
    documents = read_table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, documents, sf_dir).write.parquet(path)
        documents = spark.read.parquet(path)
    return documents
