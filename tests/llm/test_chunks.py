"""Chunks: cuts resist shifts, repeats go, clean texts stay."""

import hashlib

import numpy as np
from llm_data import PROSE, SCHEMA, row

from tokenloom.llm import chunks


def random_bytes(n, seed):
    return np.random.default_rng(seed).integers(97, 123, n, dtype=np.uint8)


def plain_cuts(data):
    """The same rule, byte by byte."""
    ends, last, gear = [], 0, 0
    for i, b in enumerate(data.tolist()):
        gear = ((gear << 1) + int(chunks._GEAR[b])) & 0xFFFFFFFF
        size = i + 1 - last
        if size == chunks.MOST or (size >= chunks.LEAST and gear & int(chunks._MASK) == 0):
            ends.append(i + 1)
            last = i + 1
    return ends + [len(data)] * (last < len(data))


def test_cuts_equal_the_byte_by_byte_rule():
    for data in (random_bytes(5000, 1), np.full(3000, 97, np.uint8), random_bytes(1, 2), random_bytes(0, 2)):
        assert chunks.cuts(data).tolist() == plain_cuts(data)


def test_insertions_move_few_cuts():
    data = random_bytes(20_000, 3)
    moved = np.concatenate((data[:5000], random_bytes(7, 4), data[5000:]))
    before, after = set(chunks.cuts(data).tolist()), {c - 7 for c in chunks.cuts(moved).tolist()}
    later = {c for c in before if c > 5600}
    assert len(later - after) == 0


def plain_result(rows, least):
    """First places by (doc_id, text hash, position): here ids differ, so by doc_id."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data, at, spans = text.encode(), 0, []
        for end in chunks.cuts(np.frombuffer(data, np.uint8)).tolist():
            name = hashlib.blake2b(data[at:end], digest_size=16).digest()
            if name in seen:
                if spans and spans[-1][1] == at:
                    spans[-1][1] = end
                else:
                    spans.append([at, end])
            seen.add(name)
            at = end
        spans = [s for s in spans if s[1] - s[0] >= least]
        kept, last = b"", 0
        for a, b in spans:
            kept, last = kept + data[last:a], b
        out[doc] = (len(data), sum(b - a for a, b in spans), len(spans), kept + data[last:])
    return out


def test_equals_plain_dedup(spark):
    shared = bytes(random_bytes(600, 9)).decode()
    rows = [(i, bytes(random_bytes(400 + 13 * i, 20 + i)).decode() + (shared if i % 3 else "") + f"end{i}") for i in range(40)]
    rows += [(100, rows[5][1]), (101, "short")]
    frame = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in chunks.dedup(frame).collect()}
    assert got == plain_result(rows, chunks.MIN_RUN)
    assert got[1][1] == 0 and got[2][1] > 300 and got[3][1] == 0 and got[100][1] > 300


def test_short_copies_and_runs_of_a_mean_chunk_go(spark):
    """Whole texts of any length, and what is left of a passage after its outer chunks are lost."""
    shared = bytes(random_bytes(95, 31)).decode()
    ends = [0, *chunks.cuts(np.frombuffer(shared.encode(), np.uint8)).tolist()]
    assert 96 > ends[-2] >= chunks.MIN_RUN
    rows = [(1, "tiny"), (2, "tiny"), (3, shared[: ends[-2]] + bytes(random_bytes(300, 32)).decode())]
    rows += [(4, shared[: ends[-2]] + bytes(random_bytes(300, 33)).decode())]
    frame = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA)
    got = {r.doc_id: r.n_removed for r in chunks.dedup(frame).collect()}
    assert got == {1: 0, 2: 4, 3: 0, 4: ends[-2]}


def test_odd_rows(odd, nothing):
    got = chunks.dedup(odd).collect()
    assert len(got) == odd.count()
    assert all(r.n_removed == 0 for r in got if r.n_bytes < len(PROSE) - 20)
    assert chunks.dedup(nothing).count() == 0
