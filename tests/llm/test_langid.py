from __future__ import annotations

from collections import Counter

import zlib

import numpy as np
import pytest

from clienttrail.llm import langid

GERMAN = "der hund und die katze laufen durch den garten und schlafen nicht weil es regnet"
ENGLISH = "the dog and the cat are running through the garden while it is not raining there"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def made(count=60):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(count):
        lang, words = (("de", GERMAN), ("en", ENGLISH))[i % 2]
        rows.append((i, " ".join(rng.choice(words.split(), 12)), lang, "s"))
    return rows


def test_accuracy_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = langid.op9_string_kernel_language(spark, folder).toPandas()
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(documents, on="doc_id")
    assert len(both) == len(documents)
    assert both["held_out"].tolist() == [held_out(d) for d in both["doc_id"]]
    assert (both["lang_pred"] == both["lang"])[both["held_out"]].mean() > 0.97
    assert both["score"].between(0, 1).all()


def test_kernel_and_product_of_matrices():
    texts = [GERMAN, ENGLISH, GERMAN[:30], ENGLISH[20:]]
    model = langid.StringKernelModel.fit([langid.gram_places(t) for t in texts], ["de", "en", "de", "en"], landmarks=2)
    grams = [set(langid.gram_places(t).tolist()) for t in texts]
    for text in ("die katze", "a cat", "x"):
        own = set(langid.gram_places(text).tolist())
        plain = sum((model.weights[i].astype(float) for i in own), np.zeros(2)) / np.sqrt(len(own))
        assert model.scores([text, "other"])[0] == pytest.approx(plain, rel=1e-5)
    kernel = len(grams[0] & grams[1]) / np.sqrt(len(grams[0]) * len(grams[1]))
    assert 0 < kernel < 1


def test_grams_come_from_the_whole_text():
    long = "a " * (1 << 18) + "zebra"
    assert len(langid.gram_places(long)) > len(langid.gram_places("a " * (1 << 18)))


def test_held_out_rows_teach_nothing(spark, frame):
    rows = made()
    odd = [(d, t, "xx" if held_out(d) else lang, s) for d, t, lang, s in rows]
    assert langid.fit_languages(frame(odd)).languages == ["de", "en"]


def test_odd_rows(spark, frame):
    model = langid.fit_languages(frame(made() + [(None, ENGLISH, "zz", "s"), (901, None, "yy", "s"), (902, "abc", None, None)]))
    assert model.languages == ["de", "en"]
    got = model.predict([None, "", "12 34 !", GERMAN, "É", ENGLISH * 5000])
    assert got["lang_pred"].tolist()[:4] == ["und", "und", "und", "de"]
    assert got["lang_pred"].tolist()[5] == "en"
    assert got["score"].tolist()[:3] == [0, 0, 0]


def test_nothing_to_learn_from(spark, frame):
    model = langid.fit_languages(frame([]))
    assert model.predict(["text"])["lang_pred"].tolist() == ["und"]


def test_stage(spark, frame):
    documents = frame(made() + [(100, None), (101, "123 456"), (102, GERMAN), (102, GERMAN)])
    kept = langid.keep_known_languages(spark, documents, "")
    assert kept.columns == documents.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [*range(60), 102, 102]
    assert langid.keep_known_languages(spark, frame([]), "").count() == 0


def test_stage_rejects_languages_not_learned(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").limit(1000)
    greek = "η γρήγορη αλεπού πηδάει πάνω από τον τεμπέλη σκύλο και τρέχει στο δάσος κάθε πρωί"
    finnish = "nopea kettu hyppää laiskan koiran yli ja juoksee metsään joka aamu sateen jälkeen"
    odd = spark.createDataFrame([(-1, greek), (-2, finnish)], "doc_id long, text string")
    both = documents.unionByName(odd, allowMissingColumns=True)
    kept = {r["doc_id"] for r in langid.keep_known_languages(spark, both, folder).select("doc_id").collect()}
    assert not kept & {-1, -2} and len(kept) > 0.98 * documents.count()


def test_rows_learnt_from_are_bounded(spark, frame):
    languages, places = langid.training_rows(frame(made(200)), per_language=10)
    assert Counter(languages) == {"de": 10, "en": 10} and len(places) == 20
    again, _ = langid.training_rows(frame(made(200) + made(200)), per_language=10)
    assert max(Counter(again).values()) <= 10


def test_weights_solve_the_whole_kernel_system():
    """Scores equal the kernel with the landmarks times coefficients of the ridge system, set by set."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list(kind), 60)) for kind in ("abcde ", "cdefg ", "xyzab ") for _ in range(6)]
    own = [k for k in ("a", "b", "c") for _ in range(6)]
    model = langid.StringKernelModel.fit([langid.gram_places(t) for t in texts], own, landmarks=4)
    sets = [set(langid.gram_places(t).tolist()) for t in texts]

    def kernel(one, two):
        return len(one & two) / np.sqrt(len(one) * len(two))

    marks = [i for i in range(18) if i % 6 < 4]
    cross = np.array([[kernel(sets[i], sets[j]) for j in range(18)] for i in marks])
    wanted = np.where(np.array(own)[:, None] == np.array(["a", "b", "c"]), 1.0, -1.0)
    among = cross[:, marks] + 1e-6 * np.eye(len(marks))
    left = sum(np.outer(cross[:, j], cross[:, j]) / 6 for j in range(18)) + 3 * langid.RIDGE * among
    alpha = np.linalg.solve(left, sum(np.outer(cross[:, j], wanted[j]) / 6 for j in range(18)))
    for text in ("abba cde", "gfe dcc", "xyz"):
        other = set(langid.gram_places(text).tolist())
        direct = np.array([kernel(sets[i], other) for i in marks]) @ alpha
        assert model.scores([text])[0] == pytest.approx(direct, abs=2e-3)


def test_regression_like_the_whole_kernel_system():
    """With every row a landmark the Nyström solution is that of kernel ridge regression on all pairs of rows."""
    rng = np.random.default_rng(12)
    kinds = {"de": GERMAN, "en": ENGLISH, "xx": "lorem ipsum dolor sit amet consectetur adipiscing elit sed do"}
    names = ["de", "en", "xx", "de", "xx", "de", "en"] * 3
    texts = [" ".join(rng.choice(kinds[n].split(), 9, replace=False)) for n in names]
    grams = [set(langid.gram_places(t).tolist()) for t in texts]

    def kernel(a, b):
        return len(a & b) / np.sqrt(len(a) * len(b))

    among = np.array([[kernel(a, b) for b in grams] for a in grams])
    weight = np.array([1 / names.count(n) for n in names])
    targets = np.array([[1.0 if n == own else -1.0 for own in ("de", "en", "xx")] for n in names])
    ridge = langid.RIDGE * 3
    alpha = np.linalg.solve(weight[:, None] * among + ridge * np.eye(len(names)), weight[:, None] * targets)

    model = langid.StringKernelModel.fit([langid.gram_places(t) for t in texts], names, landmarks=len(names))
    assert model.languages == ["de", "en", "xx"]
    asked = [*texts[:3], "die katze dolor", "running garden", "q"]
    for text, got in zip(asked, model.scores(asked)):
        own = set(langid.gram_places(text).tolist())
        assert got == pytest.approx(np.array([kernel(own, g) for g in grams]) @ alpha, abs=2e-3)
