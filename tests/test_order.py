import random
from collections import Counter

import pytest

from tokenloom.operators.order import BITS, byte_budget, dense_index, exclusive_sum, levels_for


@pytest.mark.parametrize("keys", [range(300), [0, 3, 5, 1000, 1_000_000, 2**40], [7], []])
def test_exclusive_sum_equals_a_loop(spark, keys):
    rows = [(k, random.Random(k).randint(0, 9)) for k in keys]
    want, total = {}, 0
    for k, v in sorted(rows):
        want[k] = total
        total += v
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k bigint, v bigint")
    got = exclusive_sum(df, "k", "v", "before", bits=8, key_bits=48)
    assert {r.k: r.before for r in got.collect()} == want


def test_dense_index_keeps_order(spark):
    df = spark.createDataFrame([(k * 37,) for k in range(500)], "k bigint")
    got = dense_index(df, "k", bits=5, key_bits=20).collect()
    assert {r.k: r["index"] for r in got} == {k * 37: k for k in range(500)}


@pytest.mark.parametrize("sizes, kept", [([4, 4, 4], 2), ([4, 5, 4], 2), ([9, 1], 1), ([1, 1], 2)])
def test_byte_budget_keeps_the_crossing_row(spark, sizes, kept):
    df = spark.createDataFrame(list(enumerate(sizes)), "k bigint, size bigint")
    assert sorted(r.k for r in byte_budget(df, "k", "size", 8, bits=8).collect()) == list(range(kept))


def test_no_window_without_partition_key_over_rows(spark):
    """Only the totals of the last level may share one task."""
    df = spark.range(100_000).selectExpr("id AS k", "1L AS v")
    plan = exclusive_sum(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 4
    assert sum("_bucket" not in line for line in windows) == 1


def test_random_keys_leave_every_level_small(spark):
    """Hashes spread over 64 bits: no bucket of any level, nor the last step, meets more than 2**bits keys."""
    rng = random.Random(2)
    keys = [rng.getrandbits(64) - 2**63 for _ in range(3000)]
    df = spark.createDataFrame([(k, 1) for k in keys], "k bigint, v bigint")
    want = {k: i for i, k in enumerate(sorted(keys))}
    assert {r.k: r.before for r in exclusive_sum(df, "k", "v").collect()} == want
    for level in range(1, levels_for() + 1):
        below = {k >> (BITS * (level - 1)) for k in keys}
        assert max(Counter(b >> BITS for b in below).values()) <= 1 << BITS
    assert len({k >> (BITS * levels_for()) for k in keys}) <= 1 << BITS
    assert levels_for(16, 64) == 3 and levels_for(16, 48) == 2 and levels_for(16, 10) == 1


@pytest.mark.parametrize("keys, message", [([5, 9, 5], "order key k repeats: 5"), ([1, None], "order key k is null")])
def test_keys_without_an_order_fail(spark, keys, message):
    df = spark.createDataFrame([(k, 1) for k in keys], "k bigint, v bigint")
    with pytest.raises(Exception, match=message):
        exclusive_sum(df, "k", "v").collect()
