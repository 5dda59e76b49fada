from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clienttrail.llm import spelling
from clienttrail.llm.spelling import op12_spelling_forms, spelling_forms

LETTERS = [chr(c) for c in [*range(97, 123), *range(192, 256)]]


def plain_forms(rows, min_length=7, min_count=2, damage=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % damage == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    found = {}
    for w, n in words.items():
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in LETTERS}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in LETTERS}
        near = [e for e in edits - {w} if e in words]
        best = min(near, key=lambda e: (-words[e], e), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        found[w] = [form, n, len(near), None if form is None else words[form]]
    result = set()
    for w, (form, n, n_near, form_n) in found.items():
        root = w
        while found[root][0] is not None:
            root = found[root][0]
        result.add((w, form, root, n, n_near, form_n))
    return result


def same(documents, **how):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    max_blocks = how.pop("max_blocks", spelling.MAX_BLOCKS)
    got = [tuple(r) for r in spelling_forms(documents, max_blocks=max_blocks, **how).collect()]
    wanted = plain_forms(rows, **how)
    assert len(got) == len(wanted) and set(got) == wanted
    return wanted


def test_whole_table(spark, small_dir, small_documents):
    got = {tuple(r) for r in op12_spelling_forms(spark, small_dir).collect()}
    wanted = plain_forms([(r["doc_id"], r["text"]) for r in small_documents.collect()])
    assert got == wanted and sum(w[1] is not None for w in wanted) > 0


def test_words_close_together(frame, monkeypatch):
    monkeypatch.setattr(spelling, "PROBED", 50)
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    text = "aaaaaaa " * 200 + "aaaaaaaa " * 20 + "baaaaaaa " * 2 + "aaaaaaaaa aaaabaa aaaaÿaa Aaaaßaa aaaaaab aaaaabb " * 2
    wanted = same(frame([(i, text) for i in range(3)]))
    assert {w[2] for w in wanted if w[0] == "baaaaaaa"} == {"aaaaaaa"}


def test_full_filters_only_cost_time(small_documents):
    same(small_documents.limit(40), max_blocks=1)


def test_damage_and_short_words(frame):
    rows = [(i, "the cat sat on the mat with another hat, and ANOTHER één Été étéé") for i in range(40)]
    same(frame(rows), min_length=2, min_count=1, damage=2)


def test_odd_rows(frame):
    long = "lettersÄ" * 25
    rows = [(1, None), (2, ""), (3, "!!"), (None, "wordword wordword"), (None, "wordwore wordwore"), (4, long), (4, long)]
    rows += [(5, long + "x"), (6, long + "x"), (7, "wordword\u0085wordword wordword wordword\U0001f600wordword\x00wordword")]
    wanted = same(frame(rows))
    assert {w[0] for w in wanted} >= {"wordword", "wordwore"}


def test_nothing(frame):
    assert spelling_forms(frame([])).count() == 0
    assert spelling_forms(frame([(1, "only short ones")])).count() == 0


def test_hashes_of_edits():
    word = np.frombuffer(b"letters", np.uint8)[None]
    filters = spelling.Filters({6: 1, 7: 1})
    for other in (b"leters", b"lezters"):
        row = np.frombuffer(other, np.uint8)[None]
        mixed = spelling._mixed(spelling._hashes(row))
        filters.blocks[filters.places(mixed, len(other))] |= spelling._masks(mixed)
    found = [e for part in spelling._edits(word, np.arange(97, 123, dtype=np.uint8), filters, 6) for e in zip(*part)]
    assert (0, 3, 0) in found and (0, 2, ord("z")) in found


@pytest.mark.parametrize("length", [7, 64, 65, 300])
def test_filters_know_their_words(length):
    rows = np.random.default_rng(length).integers(97, 123, (200, length)).astype(np.uint8)
    filters = spelling.Filters({min(length, spelling.LONG_WORD): 200})
    mixed = spelling._mixed(spelling._hashes(rows))
    np.bitwise_or.at(filters.blocks, filters.places(mixed, length), spelling._masks(mixed))
    assert filters.knows(spelling._hashes(rows), length).all()
    others = np.random.default_rng(1).integers(97, 123, (20_000, length)).astype(np.uint8)
    assert filters.knows(spelling._hashes(others), length).mean() < 0.03


def test_words_as_long_as_a_text(frame):
    long = "lettersÄ" * 1500
    rows = [(1, f"{long} {long}"), (2, f"{long}x {long}x"), (3, f"{long[:-1]}Ö {long[:-1]}Ö")]
    found = {len(r["word"]) + (r["word"][-1] == "Ö"): r["n_near"] for r in spelling_forms(frame(rows), damage=1 << 40).collect()}
    assert found == {12_000: 2, 12_001: 1}
