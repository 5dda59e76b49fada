from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clienttrail.llm import simhash
from clienttrail.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(rows):
    """rows (doc_id, fingerprint) -> component of each row, by all pairs."""
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if (rows[i][1] ^ rows[j][1]).bit_count() <= 3 and group[i] != group[j]:
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    least = {}
    for g, (doc_id, _) in zip(group, rows):
        least[g] = min([v for v in (least.get(g), doc_id) if v is not None], default=None)
    return [least[g] for g in group]


@pytest.mark.parametrize(
    "text", [None, "", " \n", "one", "One TWO", "a b c", "a b c d A", "É é ß x\x0by", "w " * 70_000]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_hash_is_the_one_of_spark(spark):
    value = spark.sql("select xxhash64('a b c') as h").first()["h"]
    assert value % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_whole_table(spark, small_dir, small_documents):
    got = simhash.op7_simhash_blocks(spark, small_dir).collect()
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in small_documents.collect()]
    wanted = {
        (doc, f"{print_:016x}", component)
        for (doc, print_), component in zip(rows, plain_components(rows))
    }
    assert {tuple(r) for r in got} == wanted and len(got) == len(rows)


def close_prints(seed, count):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (count, 4)).astype(np.uint64)
    return [int(b) for b in base[rng.integers(0, 4, count)] ^ np.bitwise_xor.reduce(flips, axis=1)]


@pytest.mark.parametrize("block_rows", [simhash.BLOCK_ROWS, 3])
def test_links_at_three_bits(spark, block_rows):
    """Also with blocks so small that nearly all prints are filed by finer pieces."""
    prints = close_prints(1, 120)
    rows = list(enumerate(prints))
    signed = [(i, p - (1 << 64) if p >= 1 << 63 else p) for i, p in rows]
    frame = spark.createDataFrame(signed, "doc_id long, print long")
    got = {
        r["doc_id"]: r["component_id"]
        for r in simhash.near_duplicate_groups(frame, block_rows).collect()
    }
    assert got == dict(zip(range(len(rows)), plain_components(rows)))


def test_spanning_links_connect_like_all_pairs():
    prints = np.array(close_prints(2, 60), np.uint64).view(np.int64)
    source, target = simhash.spanning_links(prints)
    assert len(source) < len(prints)
    assert all((a ^ b).bit_count() <= 3 for a, b in zip(source, target))


def test_odd_rows(frame):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (5, None), (4, ""), (None, "z y"), (9, "q")]
    rows += [(3, "a b c d e")]
    got = sorted(map(tuple, simhash.near_duplicates(frame(rows)).select("doc_id", "component_id").collect()), key=str)
    wanted = [(3, 1), (1, 1), (None, 1), (5, 4), (4, 4), (None, None), (9, 9), (3, 1)]
    assert got == sorted(wanted, key=str)
    assert simhash.near_duplicates(frame([])).count() == 0


def test_stage_keeps_one_row_of_each_group(spark, frame):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "z y x w"), (None, "z y x w")]
    rows += [(7, "k l m n o p q"), (5, None), (4, "")]
    documents = frame(rows)
    kept = simhash.keep_one_of_each_group(spark, documents, "")
    assert kept.columns == documents.columns
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in kept.collect())
    assert got == [(-1, "z y x w"), (1, "a b c d e"), (4, ""), (7, "k l m n o p q")]


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (300, None)]
    frame = spark.createDataFrame(edges + edges[:5], "a long, b long")
    got = dict(map(tuple, connected_components(frame).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert connected_components(frame.where(F.lit(False))).count() == 0
