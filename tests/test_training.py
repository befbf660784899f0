"""The SVM against a plain solver, self-training and corrections against loops."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tokenloom.operators import classify, training


def plain_fit(texts, labels):
    """Squared-hinge SVM by damped Newton steps on dense TF-IDF columns."""
    words = [re.findall("[a-z0-9_à-öø-ÿ]{2,}", t.lower()) for t in texts]
    grams = [Counter(" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)) for w in words]
    terms = sorted(set().union(*grams))
    df = Counter(t for g in grams for t in g)
    idf = {t: math.log((len(texts) + 1) / (df[t] + 1)) + 1 for t in terms}
    x = np.array([[g[t] * idf[t] for t in terms] for g in grams])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    x = np.hstack([x, np.ones((len(texts), 1))])
    names, out = sorted(set(labels)), []
    for name in names:
        y = np.where(np.array(labels) == name, 1.0, -1.0)
        w = np.zeros(x.shape[1])
        value = lambda w, y=y: w @ w / 2 + (np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
        for _ in range(200):
            left = np.maximum(0, 1 - y * (x @ w))
            slope = w - 2 * x.T @ (left * y)
            if np.linalg.norm(slope) < 1e-10:
                break
            on = x[left > 0]
            step = np.linalg.solve(np.eye(len(w)) + 2 * on.T @ on, slope)
            size = 1.0
            while value(w - size * step) > value(w) and size > 1e-12:
                size /= 2
            w = w - size * step
        out.append(w)
    return names, terms, np.array(out), x


def sentences(seed=1, n=60):
    rng = random.Random(seed)
    lists = {"fr": "le chat dort sur la table très".split(), "en": "the cat sleeps on a big table".split(), "de": "der Katze schläft auf dem Tisch".split()}
    rows = []
    for _ in range(n):
        name = rng.choice(sorted(lists))
        pool = lists[name] if rng.random() < 0.9 else lists[rng.choice(sorted(lists))]
        rows.append((" ".join(rng.choices(pool, k=rng.randrange(0, 6))), name))
    return rows


@pytest.mark.parametrize("array_entries, tolerance, distance", [(10**6, 1e-6, 1e-4), (0, 1e-2, 5e-2)])
def test_weights_equal_a_plain_solver(spark, array_entries, tolerance, distance):
    rows = sentences(n=60 if array_entries else 25)
    names, terms, want, _ = plain_fit(*zip(*rows, strict=True))
    model = classify.fit(spark.createDataFrame(rows, "text string, classe string"), tolerance=tolerance, array_entries=array_entries)
    assert model.labels == names
    got = {r.term: r.w for r in model.table.collect()}
    assert sorted(got) == terms
    assert np.abs(np.array([got[t] for t in terms]).T - want[:, :-1]).max() < distance
    assert np.abs(np.array(model.intercepts) - want[:, -1]).max() < distance


def test_predictions_equal_a_plain_solver(spark):
    rows = sentences(2)
    names, terms, weights, x = plain_fit(*zip(*rows, strict=True))
    texts = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i bigint, text string, classe string")
    model = classify.fit(texts)
    said = {r.i: r.predicted for r in model.predict(texts).collect()}
    margins = weights @ x.T
    for i in range(len(rows)):
        first, second = sorted(margins[:, i])[-1:-3:-1]
        if first - second > 1e-3:
            assert said[i] == names[int(margins[:, i].argmax())]
    again = classify.fit(texts.repartition(3))
    assert np.abs(np.array(again.intercepts) - np.array(model.intercepts)).max() < 1e-9


def test_odd_texts_and_classes(spark):
    one = classify.fit(spark.createDataFrame([("un chat", "a"), (None, "a"), ("x", None)], "text string, classe string"))
    odd = spark.createDataFrame([(None,), ("",), ("chat",), ("chat",)], "text string")
    assert [r.predicted for r in one.predict(odd).collect()] == ["a"] * 4
    none = classify.fit(spark.createDataFrame([], "text string, classe string"))
    assert [r.predicted for r in none.predict(odd).collect()] == [None] * 4
    two = classify.fit(spark.createDataFrame([("chat", "b"), ("chien", "b"), ("cat", "c")], "text string, classe string"))
    assert sorted(r.predicted for r in two.predict(odd).collect()) == ["b"] * 4
    assert two.predict(spark.createDataFrame([], "text string")).count() == 0


def ratio(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return 200 * rows[-1][-1] / (len(a) + len(b))


def plain_self_train(words, lexicon):
    """Whole fits and whole matches in every round."""
    rows, rounds = [(t, c, 0) for t, c in lexicon], 0
    while True:
        names, terms, weights, _ = plain_fit([t for t, _, _ in rows], [c for _, c, _ in rows])
        known, new = {t for t, _, _ in rows}, []
        for word in sorted(set(words) - known):
            score, place = max((ratio(word, t), -i) for i, (t, _, _) in enumerate(rows))
            margins = weights[:, -1] + (weights[:, terms.index(word)] if word in terms else 0)
            if score >= 70 and rows[-place][1] == names[int(margins.argmax())]:
                new.append((word, rows[-place][1], rounds + 1))
        if not new:
            return rows, rounds
        rows, rounds = rows + new, rounds + 1


def test_self_training_goes_on_until_nothing_is_added(spark):
    lexicon = [("chanter", "verbe"), ("chantons", "verbe"), ("danser", "verbe"), ("maison", "nom"), ("chat", "nom")]
    # Each word is near the one before it only, so every round adds some more.
    words = ["chanterasse", "chanterassentes", "chanterassentesmaxima", "maisons", "danserons", "zzzzzz", "chat"]
    rows = spark.createDataFrame([(i, t, c, "p") for i, (t, c) in enumerate(lexicon)], "row_id bigint, texte string, classe string, pos_tag string")
    got, model, rounds = training.self_train(spark.createDataFrame([(w,) for w in words], "word string"), rows)
    want, most = plain_self_train(words, lexicon)
    assert rounds == most == 3
    assert sorted((r.texte, r.classe, r.round) for r in got.collect()) == sorted(want)
    assert len({r.row_id for r in got.collect()}) == len(want)
    asked = spark.createDataFrame([("chanterassentesmaxima",)], "text string")
    assert model.predict(asked).first().predicted == "verbe"


def test_numbers_have_no_gaps(spark):
    rows = spark.range(500).selectExpr("concat('w', id) AS texte")
    assert sorted(r.row_id for r in training.numbered_after(rows, "texte", 7).collect()) == list(range(7, 507))


def test_a_correction_changes_what_the_model_says(spark):
    lexicon = spark.createDataFrame([(f"mot{i}", "nom" if i % 3 else "verbe") for i in range(12)], "texte string, classe string")
    corrections = spark.createDataFrame([("mot1", "verbe")] * 4 + [("neuf", "verbe")], "texte string, classe string")
    rows, after = training.apply_corrections(lexicon, corrections)
    asked = spark.createDataFrame([("mot1",), ("neuf",), ("mot2",)], "text string")
    before = {r.text: r.predicted for r in training.fit_lexicon(lexicon).predict(asked).collect()}
    now = {r.text: r.predicted for r in after.predict(asked).collect()}
    assert before == {"mot1": "nom", "neuf": "nom", "mot2": "nom"}
    assert now == {"mot1": "verbe", "neuf": "verbe", "mot2": "nom"}
    assert rows.count() == 17 and rows.filter("texte = 'mot1'").select("classe").distinct().count() == 2


def test_tfidf_stores_and_joins_common_terms_only(spark, monkeypatch):
    from math import log, sqrt

    from tokenloom.operators import weights

    texts = ["aa bb aa", "bb cc", "", None, "dd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    stored = []
    keep = weights.materialize
    monkeypatch.setattr(weights, "materialize", lambda t: stored.append(keep(t)) or stored[-1])
    got = {(r.doc_id, r.term): r.weight for r in weights.tfidf(df, "doc_id", 1, 1).collect()}
    assert [r.term for (t,) in [stored] for r in t.collect()] == ["bb"]
    uses = {"aa": 1, "bb": 2, "cc": 1, "dd": 1}
    idf = {t: log((1 + len(texts)) / (1 + n)) + 1 for t, n in uses.items()}
    want = {}
    for i, text in enumerate(texts):
        words = (text or "").split()
        raw = {w: words.count(w) * idf[w] for w in words}
        norm = sqrt(sum(v * v for v in raw.values()))
        want.update({(i, w): v / norm for w, v in raw.items()})
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-12 for k, v in want.items())


def test_blocks_hold_equal_columns_once_and_estimates_stay_small(spark, monkeypatch):
    made = []
    start = classify.BlockProblem.__init__
    monkeypatch.setattr(classify.BlockProblem, "__init__", lambda self, *a: made.append(self) or start(self, *a))
    rows = [("un deux trois", "a"), ("un quatre cinq", "b"), ("six sept", "a"), (None, "b")]
    model = classify.fit(spark.createDataFrame(rows, "text string, classe string"), tolerance=1e-2, array_entries=0, part_entries=2)
    (problem,) = made
    assert problem.columns.count() == 4 and model.table.count() == 14
    size = problem.docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert len(str(size)) < 20
