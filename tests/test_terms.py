import random
from collections import Counter
from math import log, sqrt

import numpy as np
import pyarrow as pa

from tokenloom.operators import terms, weights


def wanted(texts, low, high):
    """Weights by key and term; rows of one key are one text, whose n-grams don't reach over rows."""
    counts = {}
    for name, text in texts:
        words = (text or "").split()
        grams = [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]
        counts.setdefault(name, Counter()).update(grams)
    df, out = Counter(t for c in counts.values() for t in c), {}
    for name, c in counts.items():
        raw = {t: n * (log((1 + len(texts)) / (1 + df[t])) + 1) for t, n in c.items()}
        norm = sqrt(sum(v * v for v in raw.values()))
        out.update({(name, t): v / norm for t, v in raw.items()})
    return out


def test_many_blocks_and_buckets_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(terms, "WORDS", 7)
    rng = random.Random(2)
    names = ["été", "aa", "bb", "cc", "dd", "éa"]
    texts = [(i % 25 if i % 6 else None, " ".join(rng.choice(names) for _ in range(rng.randint(0, 9))) or None) for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    for low, high in ((1, 3), (2, 2)):
        made = terms.blocks(df, "doc_id", weights.term_words("text"))
        total, buckets = terms.sizes(made, low, high, bucket_terms=40)
        assert total == 40 and buckets > 3 and made.count() > 5
        common = terms.common(made, low, high, buckets)
        got = terms.weigh(made, common, "doc_id", low, high, buckets, total).collect()
        want = wanted(texts, low, high)
        assert len(got) == len(want) and all(abs(want[r.doc_id, r.term] - r.weight) < 1e-12 for r in got)
        assert all(r.df > 1 and len(r.blocks) == len(r.places) for r in common.collect())


def test_keys_may_be_texts_and_no_term_is_shuffled_alone(spark):
    texts = [("x", "aa bb aa"), ("y", "bb"), ("z", "")]
    made = weights.tfidf(spark.createDataFrame(texts, "name string, text string"), "name", 1, 2)
    assert "hashpartitioning(term" not in made._jdf.queryExecution().toString()
    want = wanted(texts, 1, 2)
    assert {(r.name, r.term): round(r.weight, 12) for r in made.collect()} == {k: round(v, 12) for k, v in want.items()}
    assert weights.tfidf(spark.createDataFrame([], "name string, text string"), "name").collect() == []


def test_pressed_numbers_and_texts_come_back():
    for values in ([], [0], [1, 255, 256, 2**40], [0] * 9):
        assert terms._opened(terms._press(np.array(values, dtype=np.int64))).tolist() == values
    words = pa.array(["", "été", "", "b" * 300, "c"]).slice(1)
    assert terms._opened_text(*terms._pressed_text(words)).to_pylist() == words.to_pylist()
