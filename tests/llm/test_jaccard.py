"""The join against all pairs."""

import re

import numpy as np
import pytest
from llm_data import FOLDER, SCHEMA, row

from tokenloom.llm import jaccard
from tokenloom.llm.shingles import shingle_sets


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_result(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i + 1, n):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    known = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(((rows[i][0], known[find(i)], links[i]) for i in range(n)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "class_id", "n_links").collect()), key=repr)


def edited(words, rate, rng):
    return " ".join(w if rng.random() > rate else f"new{rng.integers(1e6)}" for w in words)


def groups(n):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(6):
        words = [f"g{g}w{rng.integers(300)}" for _ in range(200)]
        for _ in range(n if g == 0 else 6):
            rows.append((len(rows), edited(words, [0.004, 0.01, 0.02, 0.03, 0.05, 0.0][g], rng)))
    rows += [(len(rows) + i, " ".join(f"u{i}x{k}" for k in range(50))) for i in range(20)]
    rows += [(900, None), (901, ""), (902, "one two"), (903, "one  two"), (903, "one two"), (904, "two one"), (None, "one two")]
    return rows


def test_equals_all_pairs(spark):
    rows = groups(6)
    assert result(jaccard.join(spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA))) == plain_result(rows)


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = groups(150)
    assert result(jaccard.join(spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA))) == plain_result(rows)


def test_test_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(jaccard.join(docs)) == plain_result(rows)


def test_one_per_class(spark):
    rows = groups(6)
    frame = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA)
    kept = jaccard.one_per_class(frame)
    assert kept.columns == frame.columns
    joined = plain_result(rows)
    want = {c for _, c, _ in joined if c is not None}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_shingle_hashes_follow_words():
    texts = ["a b c d e f", " a\tb\nc d  e f ", "a b c d e", "a b", "ab", "", "b a"]
    sets = shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [2, 2, 1, 1, 1, 0, 1]
    assert set(sets[0]) == set(sets[1]) and set(sets[2]) < set(sets[0])
    assert len({int(s[0]) for s in sets[3:5] + sets[6:]}) == 3


def test_pairs_above_the_threshold_are_never_dropped():
    least = jaccard.least_matches()
    rng = np.random.default_rng(0)
    for n in jaccard.STEPS:
        assert (rng.binomial(n, 0.8, 100_000) < least[n]).mean() < 1e-4


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.id: r.cluster for r in jaccard.components(frame).collect()}
    nodes = {x for e in edges for x in e}
    assert set(found) == nodes
    assert all(found[x] == (50 if x >= 50 else min(nodes)) for x in nodes)


def test_odd_rows(odd, nothing):
    assert jaccard.join(odd).count() == odd.count()
    assert jaccard.join(nothing).count() == 0 and jaccard.one_per_class(nothing).count() == 0
