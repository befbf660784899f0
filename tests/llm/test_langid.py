"""The network's gradients, accuracy and edges."""

import zlib

import numpy as np
from llm_data import FOLDER

from tokenloom.llm import langid


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = langid.new_network(["a", "b", "c"])
    p = {k: v.astype(np.float64) for k, v in net.params.items()}
    windows, lengths, labels = rng.integers(0, 256, (4, 7)), np.array([7, 3, 1, 5]), np.array([0, 2, 1, 0])
    _, grads = langid.gradients(windows, lengths, labels, p)
    for name in p:
        flat = p[name].reshape(-1)
        used = np.flatnonzero(np.abs(grads[name].reshape(-1)) > 1e-3)[:5]
        for i in used:
            old, step = flat[i], 1e-3
            flat[i] = old + step
            up = langid.gradients(windows, lengths, labels, p)[0]
            flat[i] = old - step
            down = langid.gradients(windows, lengths, labels, p)[0]
            flat[i] = old
            assert abs((up - down) / (2 * step) - grads[name].reshape(-1)[i]) < 5e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    net = langid.fit(docs)
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in langid.identify(docs, net).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) > 20 and sum(r.lang_pred == langs[r.doc_id] for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_pooling_does_not_depend_on_neighbours():
    net = langid.new_network(["a", "b"])
    texts = ["some words here", "x" * 1000, "ünïcödé", None, "123", ""]
    together = langid.label_texts(texts, net)
    for i, text in enumerate(texts):
        lang, score = langid.label_texts([text], net)
        assert lang[0] == together[0][i] and abs(score[0] - together[1][i]) < 1e-5
    assert together[0][3:] == ["und"] * 3


def test_odd_rows(odd, nothing):
    rows = langid.identify(odd, langid.fit(odd)).collect()
    assert len(rows) == odd.count()
    assert sorted(r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 8)) == ["und"] * 4
    unknown = langid.identify(odd, langid.fit(nothing)).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in unknown)
    assert langid.identify(nothing, langid.fit(nothing)).count() == 0
