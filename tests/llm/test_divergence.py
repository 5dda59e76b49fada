from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from clienttrail.llm import divergence
from clienttrail.llm.divergence import SQL, Forest, op13_source_divergence, shares, source_divergence


def plain_divergence(rows):
    """Rows (text, lang, source), priced term by term."""
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang].add(source)
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    result = set()
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= 3]

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        def ranked(values):
            return enumerate(sorted(values, key=lambda v: (-v[1], v[0].encode())), 1)

        of = {s: p(counts[lang, s]) for s in sources}
        whole = p(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((of[s][t] - of[o][t]) ** 2 // of[o][t] for t in kept)) for o in sources - {s}]
            result |= {(lang, s, "pair", *v, k) for k, v in ranked(pairs)}
            over = [(t, (of[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if counts[lang, s][t] and of[s][t] > whole[t]]
            result |= {(lang, s, "term", *v, k) for k, v in ranked(over) if k <= 200}
    return result


def same(documents):
    got = [tuple(r) for r in source_divergence(documents).select("lang", "source", "part", "item", "value", "rank").collect()]
    wanted = plain_divergence([(r["text"], r["lang"], r["source"]) for r in documents.select("text", "lang", "source").collect()])
    assert len(got) == len(wanted) and set(got) == wanted
    return wanted


def test_query_against_sql(spark, small_dir, small_documents):
    got = op13_source_divergence(spark, small_dir).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{small_dir}/documents.parquet'")
    wanted = con.sql(SQL).df()
    columns = ["lang", "source", "part", "item", "value", "rank"]
    assert list(got.columns) == columns == list(wanted.columns) and str(got["rank"].dtype) == "int32"
    assert set(got.itertuples(index=False, name=None)) == set(wanted.itertuples(index=False, name=None))
    plain = plain_divergence([(r["text"], r["lang"], r["source"]) for r in small_documents.collect()])
    assert set(got.itertuples(index=False, name=None)) == plain and len(got) == len(plain)


def test_small_blocks_and_chunks(small_documents, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    monkeypatch.setattr(divergence, "WALKED_PAIRS", 3)
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    same(small_documents.limit(30))


def test_odd_rows(frame):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "Über über ÜBER ünder", None, ""), (3, "Über the", "", None)]
    rows += [(i, "the cat THE cat x", "en", s) for i, s in enumerate("aabbb")] + [(9, "the dog", "en", "z")] * 3
    rows += [(20, "12 34 !!", "en", "empty"), (21, "alone", "de", "only"), (22, "é" * 50_000, "fr", "f"), (22, "é" * 50_000, "fr", "g"), (22, "é" * 50_000 + " ok", "fr", "g")]
    wanted = same(frame(rows))
    assert ("en", "empty", "pair", "a") in {w[:4] for w in wanted}
    assert {w for w in wanted if w[0] == "de"} == set()


def test_languages_without_kept_terms_have_prices_of_zero(frame):
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b")]
    assert same(frame(rows)) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_no_rows(frame):
    assert source_divergence(frame([])).count() == 0


@pytest.mark.parametrize("width", [1, 2, 5, 64, 100])
def test_trees_share_nodes_and_prices(width):
    rng = np.random.default_rng(width)
    counts = rng.integers(0, 3, (4, width))
    counts[1] = counts[0]
    forest = Forest(counts)
    assert forest.roots[0] == forest.roots[1]
    priced = []

    def price(pair, a, b):
        priced.append(len(a))
        known = np.append(forest.counts, 0)
        return np.abs(known[a] - known[b])

    first, second = np.array([0, 0, 2]), np.array([1, 2, 3])
    assert forest.walk(first, second, price).tolist() == np.abs(counts[first] - counts[second]).sum(axis=1).tolist()
    assert priced[0] <= 3 * 10


def test_shares_of_huge_counts():
    counts = np.array([0, 10**10, 4 * 10**12])
    assert shares(counts, [5 * 10**12], 7).tolist() == [[1 + 10**9 * (c + 1) // (5 * 10**12 + 7) for c in counts.tolist()]]
