"""Sharding: cells equal a plain k-d tree, shards near equal in bytes, slots gapless."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_data import FOLDER
from pyspark.sql import functions as F

from tokenloom.llm import shards


def whole(rows, docs, n):
    """Sizes, checksums and slots hold for every row; returns the bytes of each shard."""
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    assert set(by) <= set(range(n))
    return {s: sum(r.size for r in part) for s, part in by.items()}


def plain_tree(cell, first, leaves, keys, found):
    """The same tree by sorting whole cells; ``keys`` gives a row's sort keys, one per dimension."""
    if leaves == 1:
        found.update({row["_row"]: first for row in cell})
        return
    if not cell:
        return
    spans = [max(keys(r)[d][0] for r in cell) - min(keys(r)[d][0] for r in cell) for d in range(len(keys(cell[0])))]
    dim = spans.index(max(spans))
    cell = sorted(cell, key=lambda r: keys(r)[dim])
    left = leaves // 2
    target = sum(r["size"] for r in cell) * (left / leaves)
    at, total, best, where = 0, 0, target, 0
    for at, row in enumerate(cell, 1):
        total += row["size"]
        if abs(total - target) < best:
            best, where = abs(total - target), at
    plain_tree(cell[:where], first, left, keys, found)
    plain_tree(cell[where:], first + left, leaves - left, keys, found)


def documents(n=900, seed=5):
    rng = random.Random(seed)
    sources = ["site-a", "site-a", "site-bb", "site-c", "söurce", None]
    return [
        (i * 7 - 300, "x" * int(rng.paretovariate(0.8)) if i % 50 else None, rng.choice(["de", "en", "fr", None]), rng.choice(sources))
        for i in range(n)
    ]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("n, window_rows", [(16, 65_536), (8, 3), (7, 40), (1, 5)])
def test_cells_equal_a_plain_tree(spark, n, window_rows):
    docs = spark.createDataFrame(documents(), SCHEMA)
    rows, names = shards.sized_rows(docs, shards.DIMENSIONS)
    scales = shards.axes(rows, names)
    listed = [r.asDict() for r in rows.select("*", *[a.coordinate().alias(f"c{i}") for i, a in enumerate(scales)], *[a.key().alias(f"k{i}") for i, a in enumerate(scales)], shards.place().alias("p")).collect()]
    found = {}
    plain_tree(listed, 0, n, lambda r: [(r[f"c{i}"], r[f"k{i}"], r["p"]) for i in range(len(scales))], found)
    got = shards.shard(docs, n, window_rows=window_rows).collect()
    by_id = {r["doc_id"]: found[r["_row"]] for r in listed}
    assert {r.doc_id: r.shard for r in got} == by_id


def test_coordinates_keep_the_order_of_their_values(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    rows, names = shards.sized_rows(docs, ("source", "doc_id", "missing"))
    assert names == ["_m0", "_m1"]
    scales = shards.axes(rows, names)
    got = rows.select("_m0", "_m1", *[a.coordinate().alias(f"c{i}") for i, a in enumerate(scales)]).collect()
    for name, at in (("_m0", "c0"), ("_m1", "c1")):
        values = sorted({(r[name] is not None, r[name].encode() if isinstance(r[name], str) else r[name] or 0, r[at]) for r in got})
        numbers = [v[2] for v in values]
        assert numbers == sorted(numbers) and numbers[0] == 0 and numbers[-1] == (1 << 24) - 1


def test_one_value_or_one_id_in_most_rows_is_cut_inside(spark):
    rng = random.Random(1)
    docs = [(7, "same text", "en", "hot") for _ in range(1500)]
    docs += [(i, "y" * rng.randrange(30), "en", "hot" if i % 3 else "cold") for i in range(1000)]
    frame = spark.createDataFrame(docs, SCHEMA)
    got = shards.shard(frame, 8, window_rows=10).collect()
    sums = whole(got, [d[:2] for d in docs], 8)
    assert len(sums) == 8 and max(sums.values()) - min(sums.values()) <= 3 * 31


def test_shards_near_equal_on_a_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = shards.digest(shards.shard(docs, 16))
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    sums = whole(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], 16)
    assert max(sums.values()) - min(sums.values()) <= 4 * max(r.size for r in rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    # Metadata is alike inside a shard: far fewer pairs of shard and source than shards times sources.
    pairs = spark.createDataFrame(rows, got.schema).join(docs.select("doc_id", "source"), "doc_id")
    assert pairs.select("shard", "source").distinct().count() < 16 * docs.select("source").distinct().count() / 2


def test_target_bytes_set_the_number_of_shards(spark):
    docs = spark.createDataFrame([(i, "z" * 99, "en", "a") for i in range(100)], SCHEMA)
    got = shards.shard(docs, target_bytes=1500).collect()
    sums = whole(got, [(i, "z" * 99) for i in range(100)], 7)
    assert len(sums) == 7 and max(sums.values()) <= 1500


def test_no_python_in_the_plan(spark):
    plan = shards.shard(spark.read.parquet(f"{FOLDER}/documents.parquet"), 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


def test_odd_rows(odd, nothing):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    whole(shards.shard(odd, 4).collect(), docs, 4)
    lean = odd.select(F.col("doc_id"), F.col("text"))
    whole(shards.shard(lean, 2).collect(), docs, 2)
    assert shards.digest(shards.shard(nothing, 4)).collect() == []
