from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clienttrail.llm import sharding
from clienttrail.llm.sharding import op11_bounded_ring, ring, ring_shards


def plain_ring(keys, walks, quota):
    """Rows (key, p, q, arc), each a copy, walked around the ring together: {(key, shard): rows}."""
    room, left, placed = dict(enumerate(quota)), list(keys), Counter()
    while left:
        asked = {}
        free = {s for s, r in room.items() if r > 0}
        for row in left:
            shard = next(int(s) for s in walks[row[3]] if s in free)
            asked.setdefault(shard, []).append(row)
        left = []
        for shard, rows in asked.items():
            rows.sort(key=lambda r: r[1:3])
            for row in rows[: room[shard]]:
                placed[row[0], shard] += 1
            left += rows[room[shard] :]
            room[shard] -= min(room[shard], len(rows))
    return placed


def expected(documents, shards, slack=0.0, replicas=sharding.REPLICAS):
    arcs, walks = ring(shards, replicas)
    keys = sharding._keys(documents, arcs).collect()
    rows = [((k["doc_id"], k["size"], k["text_crc32"]), k["p"], k["q"], k["arc"]) for k in keys for _ in range(k["copies"])]
    homes = Counter(int(walks[r[3]][0]) for r in rows)
    return plain_ring(rows, walks, sharding._quotas(homes, shards, slack).tolist())


def check(result, documents, shards, slack=0.0):
    rows = result.collect()
    text = {}
    for d in documents.select("doc_id", "text").collect():
        data = (d["text"] or "").encode()
        text.setdefault((d["doc_id"], len(data) + 16, zlib.crc32(data)), []).append(1)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == {k: len(v) for k, v in text.items()}
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    found = Counter(((r["doc_id"], r["size"], r["text_crc32"]), r["shard"]) for r in rows)
    assert found == expected(documents, shards, slack)
    return slots


@pytest.mark.parametrize("shards, slack", [(40, 0.0), (7, 0.0), (7, 0.1), (1, 0.0)])
def test_against_a_walk_row_by_row(small_documents, shards, slack):
    sizes = [len(s) for s in check(ring_shards(small_documents, shards, slack=slack), small_documents, shards, slack).values()]
    if not slack:
        assert len(sizes) == shards and max(sizes) - min(sizes) <= 1


def test_finer_ranges_and_long_runs_of_copies(frame, monkeypatch):
    monkeypatch.setattr(sharding, "LISTED", 1)
    monkeypatch.setattr(sharding, "RANGE_BITS", 2)
    monkeypatch.setattr(sharding, "RUN", 10)
    monkeypatch.setattr(sharding, "NUMBERED", 5)
    rows = [(i, f"text {i}") for i in range(300)] + [(7, "copy")] * 150 + [(None, None)] * 90 + [(None, "")] * 3
    documents = frame(rows)
    sizes = [len(s) for s in check(ring_shards(documents, 9), documents, 9).values()]
    assert len(sizes) == 9 and max(sizes) - min(sizes) <= 1


def test_odd_rows(frame):
    documents = frame([(1, None), (2, ""), (3, "ä" * 100_000), (4, "x"), (4, "x"), (None, "x"), (5, "\U0001f600")])
    result = op11_bounded_ring_of(documents)
    assert {r["size"] for r in result.collect()} == {16, 200_016, 17, 20}
    check(result, documents, 40)


def op11_bounded_ring_of(documents):
    return ring_shards(documents, 40)


def test_no_rows(frame):
    assert ring_shards(frame([])).count() == 0


def test_fewer_rows_than_shards(frame):
    documents = frame([(i, "a") for i in range(3)])
    assert sorted(len(s) for s in check(ring_shards(documents), documents, 40).values()) == [1, 1, 1]


def test_growth_moves_few_rows(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))

    def moved(slack):
        one, two = ({r[0]: r[1] for r in ring_shards(rows, n, slack=slack).select("doc_id", "shard").collect()} for n in (40, 41))
        return sum(one[d] != two[d] for d in one) / len(one)

    loose, exact = moved(0.25), moved(0.0)
    assert loose < 0.08 and exact < 0.35


def test_query(spark, small_dir, small_documents):
    result = op11_bounded_ring(spark, small_dir)
    assert result.dtypes[:7] == [
        ("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
        ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int"),
    ]
    check(result, small_documents, 40)
    assert {(r["law"], r["grown_shard"]) for r in result.collect()} == {("rows", None)}
