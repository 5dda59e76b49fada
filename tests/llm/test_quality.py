from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from clienttrail.llm import quality

SETTINGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    count = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if count[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def plain_failed(stats):
    return stats[0] < 50 or 100 * stats[4] > 50 * stats[0]


def plain_distances(rows):
    """Squared distance of each vector of one pool, by the same steps in numpy."""
    floors = np.array(list(quality.FLOORS.values())) * quality.UNIT

    def estimate(x):
        x = x.astype(float)
        mean = x.mean(axis=0)
        return mean, (x.T @ x) / len(x) - np.outer(mean, mean) + np.diag(floors**2)

    def distances(mean, covariance):
        z = rows - mean
        return np.einsum("ij,jk,ik->i", z, np.linalg.inv(covariance), z)

    def nearest(distance, share):
        bins = np.floor(np.log1p(distance) * quality.BINS_PER_UNIT).astype(int)
        last = max(b for b in set(bins.tolist()) if (bins < b).sum() < len(rows) * share)
        return bins <= last, last

    middle = np.median(rows, axis=0)
    spread = np.median(np.abs(rows - middle), axis=0) * 1.4826
    best = None
    for mean, covariance in ((middle, np.diag(spread**2 + floors**2)), estimate(rows)):
        for _ in range(quality.STEPS):
            mean, covariance = estimate(rows[nearest(distances(mean, covariance), quality.CORE)[0]])
        volume = np.linalg.slogdet(covariance)[1]
        if best is None or volume < best[0] - 1e-9:
            best = volume, mean, covariance
    distance = distances(*best[1:])
    scale = max(1.0, np.expm1((nearest(distance, 0.5)[1] + 1) / quality.BINS_PER_UNIT) / quality.MEDIAN)
    return distance / scale


def vector(stats):
    n, chars, symbols, lines, repeats = stats
    values = [
        np.log(chars / n),
        np.log1p(100 * symbols / chars),
        np.log1p(100 * lines / n),
        np.log1p(100 * repeats / n),
        np.log(n),
    ]
    return np.array([np.floor(v * quality.UNIT + 0.5) for v in values])


ODD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, "a b a b a b", None, "a"),
    (4, "x y z x y z\n\nx y z x y z\n \n \n", "en", "a"),
    (None, "é ß $ % | < > # * &\x0b1\x0c2", None, None),
    (5, "w " * 300, "en", "a"),
    (5, "w " * 300, "en", "a"),
    (6, " ".join(map(str, range(30_000))), "en", "a"),
]


def test_statistics(frame):
    got = quality.text_statistics(frame(ODD)).collect()
    wanted = [(doc_id, *plain_statistics(text)) for doc_id, text, *_ in ODD]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def test_whole_table(spark, small_dir, small_documents):
    rows = quality.op1_mcd_quality(spark, small_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in small_documents.collect()}
    assert len(rows) == len(texts)
    for row in rows:
        stats = plain_statistics(texts[row["doc_id"]])
        assert tuple(row[c] for c in SETTINGS) == stats
        assert row["base_failed"] == plain_failed(stats)
        assert not (row["base_failed"] and row["kept"])


def made_text(rng, junk):
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(rng.integers(60, 200))]
    return " | ".join(words) if junk else " ".join(words)


def test_outliers_like_numpy(frame):
    rng = np.random.default_rng(4)
    rows = [(i, made_text(rng, i % 10 == 0), "en", "a") for i in range(200)]
    got = {r["doc_id"]: r for r in quality.judge_quality(frame(rows)).collect()}
    vectors = np.array([vector(plain_statistics(text)) for _, text, *_ in rows])
    wanted = plain_distances(vectors)
    assert [got[i]["distance"] for i in range(200)] == pytest.approx(wanted.tolist(), rel=1e-6)
    assert [got[i]["kept"] for i in range(200)] == [i % 10 != 0 for i in range(200)]


def test_repeats_and_lines_alone_reject(frame):
    """In a pool where no other text repeats anything."""
    rng = np.random.default_rng(8)
    rows = [(i, made_text(rng, False), "en", "a") for i in range(150)]
    words = [w for _, text, *_ in rows for w in text.split()][:400]
    own, again = words[:110], words[200:210]
    rows.append((200, " ".join(own[:60] + again[:5] * 9), "en", "a"))
    rows.append((201, " ".join(own) + "\n" + "\n".join([" ".join(again[:3])] * 30), "en", "a"))
    rows.append((202, " ".join(own + again[:3] + own[:3]), "en", "a"))
    got = {r["doc_id"]: r for r in quality.judge_quality(frame(rows)).collect()}
    assert 40 <= 100 * got[200]["n_repeat_words"] / got[200]["n_words"] <= 50
    assert not got[200]["base_failed"] and not got[201]["base_failed"]
    assert [got[i]["kept"] for i in (200, 201, 202)] == [False, False, True]


def test_small_sources_share_an_estimate(frame):
    rng = np.random.default_rng(6)
    rows = [(i, made_text(rng, i % 20 == 3), "en", f"s{i % 4}") for i in range(160)]
    rows += [(1000 + i, made_text(rng, True), "xx", "s") for i in range(5)]
    rows += [(2000, made_text(rng, False), None, None)]
    got = {r["doc_id"]: r for r in quality.judge_quality(frame(rows)).collect()}
    assert [got[i]["kept"] for i in range(160)] == [i % 20 != 3 for i in range(160)]
    # A language with few rows is judged by all rows.
    assert not any(got[i]["kept"] for i in range(1000, 1005)) and got[2000]["kept"]
    assert all(r["distance"] is not None for r in got.values())


def test_few_rows_in_all_are_judged_together(frame):
    """99 rows of three languages and none: the estimate is that of all of them."""
    rng = np.random.default_rng(9)
    rows = [(i, made_text(rng, i % 11 == 0), ("en", "de", "xx", None)[i % 4], f"s{i % 3}") for i in range(99)]
    got = {r["doc_id"]: r for r in quality.judge_quality(frame(rows)).collect()}
    wanted = plain_distances(np.array([vector(plain_statistics(text)) for _, text, *_ in rows]))
    assert [got[i]["distance"] for i in range(99)] == pytest.approx(wanted.tolist(), rel=1e-6)
    assert [got[i]["kept"] for i in range(99)] == [i % 11 != 0 for i in range(99)]


def test_few_rows_of_small_sources_are_judged_by_their_language(frame):
    rng = np.random.default_rng(7)
    rows = [(i, made_text(rng, False), "en", f"a{i % 2}") for i in range(240)]
    rows += [(1000 + i, made_text(rng, i < 3), "en", f"small{i % 2}") for i in range(6)]
    got = {r["doc_id"]: r for r in quality.judge_quality(frame(rows)).collect()}
    assert len(got) == len(rows) and all(r["distance"] is not None for r in got.values())
    assert [got[i]["kept"] for i in range(1000, 1006)] == [False] * 3 + [True] * 3
    assert all(got[i]["kept"] for i in range(240))


def test_odd_rows(frame):
    got = quality.judge_quality(frame(ODD)).collect()
    assert len(got) == len(ODD)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert kept == {1: False, 2: False, 3: False, 4: False, None: False, 5: False, 6: True}
    assert quality.judge_quality(frame([])).count() == 0


def test_no_python_in_the_plan(spark, small_dir):
    plan = quality.op1_mcd_quality(spark, small_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
