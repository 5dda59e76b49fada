from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clienttrail.llm import common


def first_of_each(rows, count):
    groups = defaultdict(list)
    for group, h, i in sorted(rows, key=lambda r: r[1:]):
        groups[group].append((group, h, i))
    return Counter(r for g in groups.values() for r in g[:count])


@pytest.mark.parametrize("copies", [0, 900])
def test_smallest_of_each(spark, copies):
    """Large, small and null groups; copies of one hash leave too few under the bound."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 50 == 0, "small").when(F.col("id") % 3 > 0, "large").alias("name"),
        F.xxhash64("id").alias("hash"), "id",
    )
    late = F.lit((1 << 63) - 1)
    rows = rows.unionByName(spark.range(copies).select(F.lit("late").alias("name"), late.alias("hash"), "id"))
    found = common.smallest_of_each(rows, "name", 20, "id")
    assert found.columns == ["name", "hash", "id"]
    assert Counter(map(tuple, found.collect())) == first_of_each([tuple(r) for r in rows.collect()], 20)


def test_few_rows():
    texts = ["a" * 5, None, "b" * 30, "", "c" * 4, "d" * 4]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = [p.column("text").to_pylist() for p in common.few_rows(batch, 10)]
    assert [t for p in parts for t in p] == texts and all(sum(len(t or "") for t in p[1:]) <= 10 for p in parts)
    assert list(common.few_rows(batch.slice(0, 0), 10)) == []


def test_shared_folder_off_this_machine():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
