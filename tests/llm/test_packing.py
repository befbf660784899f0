"""Packing: exact ids, gapless sequences, first fit."""

import gc
import weakref
import zlib

import numpy as np
import pytest

from tokenloom.llm import packing
from tokenloom.llm.queries import tokenizer_path

TEXTS = [
    "", "a", " a", "a ", "a  b", "\n", "a\n\nb", "a \nb", "a\n b", "it's don't 'S\n's x", "€ a€ b", "a\t b",
    "<|endoftext|> x", "  x  y", "x\x1cy \x1c z", "a\r\nb c", "a.. b.", "U.S. e.g., b.", "x!? y", "é, é. ñandú über.", "日本語 テキスト 😀 ok",
    "the cat. The dog, the cat.\nThe cat", "a1 b2, c3.",
]


def test_ids_equal_the_tokenizer():
    encoder = packing.WordEncoder(tokenizer_path(), room=5)
    for text in TEXTS * 2:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == want, text


def test_an_encoder_goes_with_its_task():
    """A reused worker doesn't hold the words of the task before until the collector comes."""
    encoder = packing.WordEncoder(tokenizer_path())
    encoder.encode("the cat. The dog")
    seen = weakref.ref(encoder)
    gc.disable()
    try:
        del encoder
        assert seen() is None
    finally:
        gc.enable()


def test_first_fit_decreasing():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1024, 500)
    bins, offsets = packing.first_fit_decreasing(sizes, 1024)
    rooms, want = [], np.zeros(500, dtype=int)
    for i in np.argsort(-sizes, kind="stable"):
        at = next((b for b, r in enumerate(rooms) if r >= sizes[i]), len(rooms))
        if at == len(rooms):
            rooms.append(1024)
        want[i] = at
        assert offsets[i] == 1024 - rooms[at]
        rooms[at] -= sizes[i]
    assert bins.tolist() == want.tolist()


def check(rows, docs):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for group in by_sequence.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    encoder = packing.WordEncoder(tokenizer_path())
    for doc, text in docs.items():
        ids, at = encoder.encode(text) + b"\0\0\0\0", 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            piece = ids[4 * at : 4 * (at + r.length)]
            assert r.start == at and r.ids_crc32 == zlib.crc32(piece) and r.doc_tokens == len(ids) // 4
            at += r.length
        assert at == len(ids) // 4
    return by_sequence


@pytest.mark.parametrize("group_pieces", [8192, 7])
def test_every_id_has_one_place(spark, group_pieces):
    docs = {i: " ".join(f"w{i}x{j}" for j in range(i * 3 % 700)) for i in range(120)} | {1000: None, 1001: "y " * 5000}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    pieces = packing.token_pieces(frame, tokenizer_path()).cache()
    assert all(len(r.ids) == r.length for r in pieces.collect())
    packed = packing.pack(pieces, group_pieces).collect()
    assert len(packed) == pieces.count()
    sequences = check(packed, docs)
    if group_pieces == 8192:
        used = sum(r.length for r in packed)
        assert used / (1024 * len(sequences)) > 0.97


def test_ids_meet_their_piece_again(spark):
    docs = spark.createDataFrame([(i % 7, " ".join(f"w{j}" for j in range(i * 37))) for i in range(60)] + [(3, "copy")] * 50, "doc_id long, text string")
    with_ids = packing.pack(packing.token_pieces(docs, tokenizer_path()), group_pieces=11).collect()
    without = packing.pack(packing.token_pieces(docs, tokenizer_path(), False), group_pieces=11).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in with_ids)
    assert sorted(r[:5] for r in with_ids) == sorted(r[:5] for r in without)
    assert len({(r.sequence_id, r.offset) for r in with_ids}) == len(with_ids) == len(without)


def test_repeated_rows_go_to_many_groups(spark):
    docs = spark.createDataFrame([(1, "the same text")] * 400, "doc_id long, text string")
    packed = packing.pack(packing.token_pieces(docs, tokenizer_path(), False), group_pieces=20).collect()
    assert len({r.sequence_id >> 33 for r in packed}) > 10


def test_odd_rows(odd, nothing):
    encoder = packing.WordEncoder(tokenizer_path())
    want = sorted(len(encoder.encode(r.text)) // 4 + 1 for r in odd.collect())
    packed = packing.pack_documents(odd, tokenizer_path()).collect()
    assert sorted(r.doc_tokens for r in packed if r.start == 0) == want
    assert sum(r.length for r in packed) == sum(want) and all(len(r.ids) == r.length for r in packed)
    for doc in (2, 3, 8, 9, None):
        assert any(r.doc_id == doc for r in packed)
    assert packing.pack_documents(nothing, tokenizer_path()).count() == 0
