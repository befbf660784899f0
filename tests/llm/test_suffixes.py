"""Suffix dedup against a count of all strings."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_data import SCHEMA, row

from tokenloom.llm import chunks, suffixes


def plain_result(rows):
    span, counts = suffixes.SPAN, Counter()
    for _, text in rows:
        data = (text or "").encode()
        counts.update(data[i : i + span] for i in range(len(data) - span + 1))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - span + 1):
            if counts[data[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for a, b in zip(b"\0" + bytes(gone), bytes(gone), strict=False) if b and not a)
        out.append((doc, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def text_of(n, seed):
    words = np.random.default_rng(seed).integers(0, 400, n)
    return " ".join(f"w{w}" for w in words)


def cases():
    base, passage = text_of(500, 1), text_of(130, 2)
    rows = [(i, text_of(80 + i, 10 + i) + passage + text_of(60, 90 + i)) for i in range(30)]
    rows += [(100, base), (101, base), (102, base.replace("w7 ", "w8 ")), (103, base[100:]), (104, base[:399]), (105, base[:400])]
    rows += [(106, "ab " * 400), (107, "é" * 500), (108, None), (109, ""), (110, "x" * 399), (111, passage + passage)]
    rows += [(112, text_of(300, 77))] * 2 + [(None, base), (113, text_of(50, 5) + "x" * 700)]
    # The same 400 bytes with other bytes before and after, at every distance.
    core = text_of(120, 6)[:400]
    rows += [(200 + i, text_of(i, 300 + i) + core[i % 3 :] + text_of(9, 400 + i)) for i in range(40)]
    return rows


@pytest.mark.parametrize("part,run", [(40_000, 40_000), (8, 50)])
def test_equals_all_strings(spark, monkeypatch, part, run):
    monkeypatch.setattr(suffixes, "PART_ITEMS", part)
    monkeypatch.setattr(suffixes, "RUN_ITEMS", run)
    rows = cases()
    frame = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA)
    got = chunks.digest(suffixes.dedup(frame)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_result(rows)


def test_a_core_with_equal_keys_is_not_one_task(spark, monkeypatch):
    """A common passage: the same 400 bytes to the right of an anchor, other bytes to the left in every text."""
    monkeypatch.setattr(suffixes, "PART_ITEMS", 8)
    monkeypatch.setattr(suffixes, "RUN_ITEMS", 10)
    passage = text_of(250, 3)[:900]
    rows = [(i, text_of(60 + i % 9, 500 + i) + passage + text_of(20, 900 + i)) for i in range(60)]
    at = int(next(a for a in suffixes.anchors(np.frombuffer(passage.encode(), np.uint8)) if a < 191))
    held = [(i, i, t, [t.index(passage) + at]) for i, t in rows] + [(99, 99, text_of(150, 42), [0, 1, 2, 3])]
    runs = suffixes.sorted_runs(spark.createDataFrame(held, "_doc long, _text long, text string, places array<int>"))
    _, shared = suffixes.splitters(runs.cache(), 8)
    assert shared == {passage[at : at + suffixes.CORE].encode()}
    frame = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA)
    got = chunks.digest(suffixes.dedup(frame)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_result(rows)


@pytest.mark.parametrize("runs", [1, 2, 5, 8])
def test_loser_tree_merges_with_prefixes(runs):
    rng = np.random.default_rng(runs)
    parts = [sorted(bytes(rng.integers(97, 99, rng.integers(0, 12), dtype=np.uint8)) for _ in range(rng.integers(1, 60))) for _ in range(runs)]
    coded = [suffixes.front_code(p) for p in parts]
    for p, (common, rest) in zip(parts, coded, strict=True):
        assert suffixes.front_decode(common, np.array([len(k) for k in p]), rest) == p
    tree = suffixes.LoserTree([(p, c[0].tolist()) for p, c in zip(parts, coded, strict=True)])
    last, out = b"", []
    for run, index, common in tree:
        key = parts[run][index]
        want = next((i for i, (a, b) in enumerate(zip(last, key, strict=False)) if a != b), min(len(last), len(key)))
        assert common == want
        out.append(key)
        last = key
    assert out == sorted(k for p in parts for k in p)


def test_anchors_are_the_same_in_equal_strings():
    text = np.frombuffer(text_of(400, 8).encode(), np.uint8)
    moved = np.concatenate((np.frombuffer(b"something before", np.uint8), text))
    inner = {a for a in suffixes.anchors(text).tolist()}
    assert inner <= {a - 16 for a in suffixes.anchors(moved).tolist()}
    for p in range(len(text) - suffixes.SPAN + 1):
        assert any(p <= a < p + suffixes.REACH for a in inner)


def test_odd_rows(odd, nothing):
    assert suffixes.dedup(odd).count() == odd.count()
    assert suffixes.dedup(nothing).count() == 0
