from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from clienttrail.llm import substring
from clienttrail.llm.fm_index import FmIndex, RankBits, WaveletMatrix


def plain_removal(rows, window=35):
    """(number of words, kept words) of each row by counting all windows."""
    texts = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    count = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for words in texts:
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            if count[tuple(words[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        out.append((len(words), [w for w, k in zip(words, keep) if k]))
    return out


def digests(rows):
    return sorted(
        (str(doc_id), n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
        for (doc_id, _), (n, kept) in zip(rows, plain_removal(rows))
    )


def found(frame):
    return sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in frame.collect())


def test_whole_table(spark, small_dir, small_documents):
    rows = [(r["doc_id"], r["text"]) for r in small_documents.collect()]
    assert found(substring.op10_fm_substring_dedup(spark, small_dir)) == digests(rows)


def made_rows(seed, documents=25):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(30))
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 120)]
    rows = []
    for i in range(documents):
        words = [word() for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            words += rng.choice(passages) + [word() for _ in range(rng.randrange(5))]
        rows.append((i, " ".join(words)))
    periodic = ("x y " * 50, "z " * 80, "p q r " * 14)
    return rows + [(100 + i, t) for i, t in enumerate(periodic)]


@pytest.mark.parametrize("anchor_segments, shard_words", [(10_000, 600_000), (0, 600_000), (3, 300)])
def test_all_windows(frame, anchor_segments, shard_words):
    """Also with every anchor counted window by window, and with many shards."""
    rows = made_rows(anchor_segments)
    documents = frame(rows)
    masks = substring.repeats(documents, shard_words, anchor_segments)
    judged = {
        r["row"]["doc_id"]: substring.kept_words(r["row"]["text"], r["removals"])
        for r in substring.with_removals(documents, masks).collect()
    }
    wanted = {d: (n, [w.encode() for w in kept]) for (d, _), (n, kept) in zip(rows, plain_removal(rows))}
    assert judged == wanted


def test_odd_rows(frame):
    passage = " ".join(f"w{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, passage), (None, passage), (4, "tail\x0b" + passage), (5, "w1")]
    rows += [(6, "only once " + " ".join(f"v{i}" for i in range(90)))]
    assert found(substring.remove_repeats(frame(rows))) == digests(rows)
    assert substring.remove_repeats(frame([])).count() == 0


def test_long_text(frame, monkeypatch):
    """Texts longer than what is looked at together, with repeats across the border."""
    rng = random.Random(3)
    words = [f"{rng.randrange(10**9)}" for _ in range(substring.STRETCH + 500)]
    at = substring.STRETCH - 20
    rows = [(1, " ".join(words)), (2, "x " + " ".join(words[at : at + 60]) + " y")]
    assert found(substring.remove_repeats(frame(rows))) == digests(rows)


def test_stage(spark, frame):
    passage = " ".join(f"w{i}" for i in range(50))
    documents = frame([(1, f"head  {passage} tail"), (2, passage), (3, "a  b"), (4, None), (5, "")])
    kept = substring.cut_repeats(spark, documents, "")
    assert kept.columns == documents.columns and kept.dtypes == documents.dtypes
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()}
    assert got == {1: ("head tail", 9), 3: ("a  b", 4), 4: (None, None), 5: ("", 0)}


def test_rank():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, 200)
    at = np.arange(201)
    assert RankBits(bits).ones(at).tolist() == [int(bits[:i].sum()) for i in at]
    sequence = rng.integers(0, 11, 300)
    matrix = WaveletMatrix(sequence, 11)
    for symbol in range(11):
        counts = matrix.rank(np.full(301, symbol), np.arange(301))
        assert counts.tolist() == [int((sequence[:i] == symbol).sum()) for i in range(301)]


@pytest.mark.parametrize("longest", [5, 9, 35])
def test_matching_statistics(longest):
    rng = np.random.default_rng(longest)
    sequences = [rng.integers(0, 3, rng.integers(1, 40)).astype(np.uint64) for _ in range(12)]
    weights = rng.integers(1, 4, len(sequences))
    index = FmIndex(sequences, weights, longest)
    length, weight = index.matching_statistics()
    count = Counter()
    for own, times in zip(sequences, weights):
        for i in range(len(own)):
            for n in range(1, min(longest, len(own) - i) + 1):
                count[tuple(own[i : i + n])] += times
    for start, own in zip(index.starts, sequences):
        for i in range(len(own)):
            n = min(longest, len(own) - i)
            assert (length[start + i], weight[start + i]) == (n, count[tuple(own[i : i + n])])


def test_against_sql(spark, small_dir, small_documents):
    import duckdb

    from clienttrail.llm.queries import oracle_sql

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small_dir}/documents.parquet'")
    wanted = con.execute(oracle_sql()["op10_fm_substring_dedup"]).fetchall()
    got = substring.op10_fm_substring_dedup(spark, small_dir)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
