import gc
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import blocks, encoding, vocabulary, windows
from tokenloom.sources import readers

TEXTS = [(7, "a b\ta c\x1cb"), (3, "b  é\n\na"), (5, None), (9, ""), (1, " x y " * 11), (8, "z")]


def made(spark, texts=TEXTS, tokens=4):
    whole = blocks.word_blocks(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2), tokens=tokens)
    return whole, blocks.spans(whole)


def stream(texts=TEXTS):
    return [(doc, pos, word) for doc, text in sorted(texts, key=lambda r: r[0]) for pos, word in enumerate((text or "").split())]


@pytest.mark.parametrize("tokens", [1, 4, 1000])
def test_blocks_encode_like_token_rows(spark, tokens):
    whole, placed = made(spark, tokens=tokens)
    assert max(len(r.codes) for r in whole.collect()) <= tokens
    words = [w for *_, w in stream()]
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    vocab = blocks.vocabulary(whole, placed, 5)
    assert sorted(tuple(r) for r in vocab.collect()) == sorted((w, i + 5, words.count(w)) for w, i in ids.items())
    got = blocks.rows(blocks.encode(whole, placed, vocab)).orderBy("gpos").collect()
    assert [tuple(r) for r in got] == [(d, p, g, ids[w] + 5) for g, (d, p, w) in enumerate(stream())]


def test_chunks_and_lines_of_texts_equal_those_of_tokens(spark):
    whole, placed = made(spark)
    texts = blocks.encode(whole, placed, blocks.vocabulary(whole, placed)).checkpoint()
    rows = blocks.rows(texts)
    for context, chunk in ((2, 5), (3, 4), (8, 100)):
        one, two = (f(t, context, chunk).orderBy("chunk_id").collect() for f, t in ((windows.chunks_of, texts), (windows.chunks, rows)))
        assert one == two and one
    assert sorted(encoding.id_lines_of(texts, 6).collect()) == sorted(encoding.id_lines(rows, 6).collect())
    with pytest.raises(ValueError):
        windows.chunks_of(texts, 3, 3)
    # Chunks are put together from parts of texts: nothing is exploded per token.
    plan = windows.chunks_of(texts, 2, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and plan.count("Generate explode(sequence") == 1


def test_decode_and_sizes(spark):
    whole, placed = made(spark)
    named = blocks.words(whole).withColumn("word", F.when(~F.col("token").isin("a", "x"), F.upper("token")))
    want = {}
    for doc, _, word in stream():
        want.setdefault(doc, []).append("" if word in ("a", "x") else word.upper())
    got = {r.doc_id: r.text for r in blocks.decode(whole, placed, named).collect()}
    assert got == {d: " ".join(w).strip(" ") for d, w in want.items()}
    sums = {}
    for gpos, (*_, word) in enumerate(stream()):
        n, size = sums.get(gpos // 6, (0, 0))
        sums[gpos // 6] = n + 1, size + len(word.encode()) + 1
    assert {r.block: (r.tokens, r.bytes) for r in blocks.sizes(whole, placed, 6).collect()} == sums


@pytest.mark.parametrize("texts, message", [([(1, "a"), (1, "")], "repeats"), ([(1, "a"), (None, "b")], "is null")])
def test_texts_without_an_order_fail(spark, texts, message):
    with pytest.raises(Exception, match=message):
        made(spark, texts)


def test_a_lacking_word_fails(spark):
    whole, placed = made(spark)
    vocab = blocks.vocabulary(whole, placed).filter("token <> 'é'")
    with pytest.raises(Exception, match="needs one value"):
        blocks.encode(whole, placed, vocab).collect()


def test_no_texts(spark):
    whole, placed = made(spark, [])
    vocab = blocks.vocabulary(whole, placed)
    assert vocab.count() == blocks.encode(whole, placed, vocab).count() == 0


def test_splits_meet_their_offsets_by_broadcast(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("1 2\x1c3\n4 é 5 6")
    rows = readers.read_word_stream(spark, str(tmp_path), " ")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    assert [tuple(r) for r in rows.orderBy("gpos").collect()] == list(enumerate(["1", "2", "3", "4", "é", "5", "6"]))


def test_few_blocks_share_a_file(spark):
    """A reader or writer of parquet holds many rows of a file at once, and a block is megabytes."""
    docs = spark.createDataFrame([(i, "a b c d") for i in range(40)], "doc_id bigint, text string").coalesce(1)
    files = blocks.word_blocks(docs, tokens=4).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 40 and max(r["count"] for r in files) <= 8


def test_words_of_a_block_go_with_it(spark, monkeypatch):
    """A table of words in a cycle would stay until Python looks for cycles, and so a worker would grow with its blocks."""
    docs, found = spark.createDataFrame([(0, "")], "doc_id bigint, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: found.append(f) or self)
    blocks.word_blocks(docs)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60, 0, -1)), "text": [f"a b{i} c{i}" for i in range(60)]})
    tables = lambda: sum(type(o) is defaultdict for o in gc.get_objects())
    blocks.word_blocks(docs, tokens=10)
    gc.collect()
    before = tables()
    gc.disable()
    try:
        made = [b.num_rows for b in found[-1](iter([batch]))]
        assert len(made) == 18 and tables() <= before
    finally:
        gc.enable()
