"""Top-k against all scores."""

import math

import numpy as np

from tokenloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, ids binary, score long"


def brute(rows):
    clip = lambda x: max(-(2**63), min(2**63 - 1, x))
    vectors = [(i, [clip(math.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in vectors:
        if q % 50 == 0:
            scored = sorted((-clip(sum(x * y for x, y in zip(a, b, strict=True))), i) for i, b in vectors if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, b"x", 2) for i, v in rows], SCHEMA)


def result(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_many_blocks_equal_all_scores(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype("f4")]) for i in range(1200)]
    assert result(topk.top_k(frame(spark, rows))) == brute(rows)


def test_ties_nulls_lengths_and_large_values(spark):
    same = [1.0, 0.5, -0.25]
    rows = [(i, same) for i in range(0, 130)]
    rows += [(200, None), (250, [1.0, None, 2.0]), (300, [1.0, float("nan"), 2.0]), (350, [float("inf"), 0.0, 0.0])]
    rows += [(400, [1.0, 2.0]), (401, [3.0, 4.0]), (None, same), (450, [2.0**40, -(2.0**40), 1.0]), (451, [2.0**40, 2.0**39, -1.0]), (500, [])]
    assert result(topk.top_k(frame(spark, rows))) == brute(rows)


def test_repeated_rows_count_each(spark):
    rows = [(0, [1.0]), (0, [2.0]), (1, [1.0]), (1, [1.0]), (2, [3.0])]
    got = result(topk.top_k(frame(spark, rows)))
    assert got == sorted([(0, 1, 2, 256 * 768), (0, 2, 1, 256 * 256), (0, 3, 1, 256 * 256), (0, 1, 2, 512 * 768), (0, 2, 1, 512 * 256), (0, 3, 1, 512 * 256)])


def test_scores_beyond_long_count_as_its_end(spark):
    rows = [(i, [(-1.0) ** i * 2.0 ** (50 + i), 3.0]) for i in range(0, 75)] + [(100, [2.0**52, 1.0]), (150, [-(2.0**70), 0.0])]
    got = result(topk.top_k(frame(spark, rows)))
    assert got == brute(rows) and {s for *_, s in got} >= {2**63 - 1}


def test_one_id_with_several_vectors(spark):
    rows = [(0, [1.0]), (0, [1.0, 2.0]), *[(i, [float(i)]) for i in range(1, 9)], *[(i, [1.0, float(i)]) for i in range(11, 19)]]
    assert result(topk.top_k(frame(spark, rows))) == brute(rows)


def test_one_id_across_block_edges(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(3)
    rows = [(50, [float(x) for x in rng.normal(size=4).astype("f4")]) for _ in range(10)]
    rows += [(i, [float(x) for x in rng.normal(size=4).astype("f4")]) for i in range(60)]
    assert result(topk.top_k(frame(spark, rows))) == brute(rows)


def test_floors_of_the_first_shard_skip_blocks_and_no_result(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in (rng.normal(size=6) + 8 * np.eye(6)[i * 6 // 900]).astype("f4")]) for i in range(900)]
    assert result(topk.top_k(frame(spark, rows), shard_blocks=4)) == brute(rows)
    ids = np.arange(4)
    documents = [(ids + 10 * b, np.full((4, 1), v), np.array([v]), np.array([v])) for b, v in enumerate((1, 5, 3))]
    (best, found), = topk.search_cell([(np.array([99]), np.array([[1]]), np.array([5.0]))], documents, 2)
    assert best.tolist() == [[5, 5]] and found.tolist() == [[10, 11]]
    (best, found), = topk.search_cell([(np.array([99]), np.array([[1]]), np.array([6.0]))], documents, 2)
    assert (best == -np.inf).all()


def test_no_rows(spark):
    assert topk.top_k(frame(spark, [])).count() == 0
