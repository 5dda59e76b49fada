from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clienttrail.llm import neighbours


def plain(rows, is_query, count=10):
    """Nearest of each query among the usable rows, by all distances."""
    usable = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    ]
    out = {}
    for query, vector in usable:
        if is_query(query):
            near = [(np.sqrt(((w - vector) ** 2).sum()), i) for i, w in usable if i != query]
            out[query] = [(i, d) for d, i in sorted(near)[:count]]
    return out


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        own.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own)
    return out


def recall(got, wanted):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in wanted.items())
    return hits / sum(map(len, wanted.values()))


def test_whole_table(spark, small_dir):
    got = grouped(neighbours.op6_stable_projections(spark, small_dir).collect())
    table = spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()
    rows = [(r["vec_id"], list(r["embedding"])) for r in table]
    wanted = plain(rows, lambda i: i % 100 == 0)
    assert got.keys() == wanted.keys() and recall(got, wanted) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for query, near in got.items():
        assert len(near) == 10 and query not in dict(near)
        for i, score in near:
            assert score == pytest.approx(np.sqrt(((vectors[query] - vectors[i]) ** 2).sum()), abs=1e-15)
        assert near == sorted(near, key=lambda x: (x[1], x[0]))


@pytest.mark.parametrize("cell_rows", [16_384, 100])
def test_recall_over_cells(spark, cell_rows):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 24))
    points = centres[rng.integers(0, 12, 1500)] + 0.2 * rng.normal(size=(1500, 24))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest_neighbours(frame, F.col("vec_id") % 25 == 0, cell_rows=cell_rows)
    wanted = plain(rows, lambda i: i % 25 == 0)
    assert recall(grouped(found.collect()), wanted) >= 0.95


def test_each_length_is_searched_on_its_own(spark):
    rng = np.random.default_rng(2)
    rows = [(0, [1.0])] + [(i, rng.normal(size=(3, 6, 6, 6)[i % 4]).tolist()) for i in range(1, 900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest_neighbours(frame, F.col("vec_id") % 10 == 0, cell_rows=200)
    got, wanted = grouped(found.collect()), {}
    for size in (1, 3, 6):
        wanted |= plain([r for r in rows if len(r[1]) == size], lambda i: i % 10 == 0)
    assert len(wanted) == 90 and wanted.pop(0) == []
    assert got.keys() == wanted.keys() and recall(got, wanted) >= 0.95
    assert {len(near) for near in got.values()} == {10}


def test_equal_vectors_and_ties(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100, [0.0, 1.0]), (101, [2.0, 1.0]), (102, [2.0, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = grouped(neighbours.nearest_neighbours(frame, F.col("vec_id").isin(0, 20, 100)).collect())
    assert [i for i, _ in got[0]] == list(range(1, 11))
    assert [i for i, _ in got[20]] == list(range(10))
    assert [i for i, _ in got[100]] == list(range(10))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(7, [1.0, 2.5]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (None, [1.0, 2.0]), (9, [1.0, 2.0, 3.0])]
    kinds = "vec_id long, embedding array<float>, rank int, vector string"
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], kinds)
    got = grouped(neighbours.nearest_neighbours(frame, F.col("vec_id") % 4 == 0).collect())
    assert got == {0: [(8, 0.0), (7, 0.5)], 8: [(0, 0.0), (7, 0.5)]}
    for none in (frame.where("vec_id = 1"), frame.where(F.lit(False))):
        assert neighbours.nearest_neighbours(none, F.lit(True)).count() == 0
    assert neighbours.nearest_neighbours(frame.where("vec_id = 0"), F.lit(True)).count() == 0


def test_chi_square_quantile():
    assert neighbours.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert neighbours.chi_square_quantile(0.5, 2) == pytest.approx(1.386, abs=1e-3)
