import pytest
from pyspark.sql import functions as F

from tokenloom.functions.sequences import pad_left, trailing_context, window_structs, word_ngrams
from tokenloom.operators import windows


@pytest.mark.parametrize("n, context, chunk", [(46, 3, 10), (45, 3, 10), (3, 3, 10), (10, 3, 10), (200, 8, 9), (60, 2, 50)])
def test_chunks_cover_the_stream(spark, n, context, chunk):
    ids = [i * 7 % 31 for i in range(n)]
    df = spark.createDataFrame(list(enumerate(ids)), "gpos bigint, id bigint")
    made = windows.examples(windows.chunks(df, context, chunk), context).collect()
    # Every position with a full context is a target once, and its context is what stands before it.
    assert sorted(r.target_pos for r in made) == list(range(context, n))
    assert all(r.context == ids[r.target_pos - context : r.target_pos] and r.target == ids[r.target_pos] for r in made)
    # A chunk adds chunk - context new targets, so the chunk of a target follows from its position.
    assert all(r.chunk_id == (r.target_pos - context) // (chunk - context) + 1 for r in made)
    table = windows.chunk_stats(df, context, chunk, 4).orderBy("chunk_id").collect()
    sizes = {}
    for r in made:
        sizes[r.chunk_id] = sizes.get(r.chunk_id, 0) + 1
    assert {r.chunk_id: r.examples for r in table} == sizes
    assert all(r.seen_tokens == context + sum(v for k, v in sizes.items() if k <= r.chunk_id) for r in table)
    assert all(r.batches == -(-r.examples // 4) for r in table)


def test_chunk_must_exceed_context(spark):
    with pytest.raises(ValueError):
        windows.chunk_assign(spark.range(1).withColumnRenamed("id", "gpos"), 3, 3)


@pytest.mark.parametrize("ids, want", [([1, 2, 3, 4], [([1, 2, 3], 4)]), ([1, 2, 3], [])])
def test_window_structs(spark, ids, want):
    df = spark.createDataFrame([(ids,)], "ids array<bigint>").select(window_structs("ids", 3).alias("w"))
    assert [(r.context, r.target) for r in df.first().w] == want


def test_batches_fill_up_and_repeat(spark):
    df = spark.createDataFrame([(1 + i // 7, i) for i in range(18)], "chunk_id bigint, target_pos bigint")
    one = windows.shuffle_batches(df, 3, 1).collect()
    assert sorted(one) == sorted(windows.shuffle_batches(df, 3, 1).collect())
    assert sorted(one) != sorted(windows.shuffle_batches(df, 3, 2).collect())
    sizes = {}
    for r in one:
        sizes[(r.chunk_id, r.batch_id)] = sizes.get((r.chunk_id, r.batch_id), 0) + 1
    assert sizes == {(1, 0): 3, (1, 1): 3, (1, 2): 1, (2, 0): 3, (2, 1): 3, (2, 2): 1, (3, 0): 3, (3, 1): 1}


def test_padding_and_trailing(spark):
    df = spark.createDataFrame([([7, 8],)], "ids array<bigint>")
    assert df.select(pad_left("ids", 4)).first()[0] == [0, 0, 7, 8]
    assert df.select(pad_left("ids", 1)).first()[0] == [8]
    assert df.select(trailing_context("ids", F.lit(9), 2)).first()[0] == [8, 9]
    assert df.select(trailing_context("ids", F.lit(9), 8)).first()[0] == [7, 8, 9]


@pytest.mark.parametrize("words", [[], ["a"], ["a", "b"], ["a", "b", "a", "c"]])
def test_word_ngrams(spark, words):
    df = spark.createDataFrame([(words,)], "w array<string>").select(word_ngrams("w"))
    want = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert sorted(df.first()[0]) == sorted(want)


def test_progress_is_cumulative(spark):
    ids = spark.createDataFrame([(i,) for i in range(25)], "gpos bigint")
    first = spark.createDataFrame([(0,), (3,), (21,)], "gpos bigint")
    rows = windows.progress(ids, first, 10).orderBy("block").collect()
    assert [tuple(r) for r in rows] == [(0, 10, 2, 0.2), (1, 20, 2, 0.0), (2, 25, 3, 0.2)]


def test_chunks_keep_nulls_and_refuse_ids_they_cannot_hold(spark):
    ids = [5, None, 0, 2**40, None, 7]
    df = spark.createDataFrame(list(enumerate(ids)), "gpos bigint, id bigint")
    assert [r.ids for r in windows.chunks(df, 1, 10).collect()] == [ids]
    for bad in (-1, 2**62):
        with pytest.raises(Exception, match="id outside of"):
            windows.chunks(df.union(spark.createDataFrame([(6, bad)], df.schema)), 1, 10).collect()


@pytest.mark.parametrize("n, size", [(46, 3), (45, 2), (4, 5), (60, 7)])
def test_batches_inside_chunks_equal_those_of_a_shuffle(spark, n, size):
    df = spark.createDataFrame([(i, i * 7 % 31) for i in range(n)], "gpos bigint, id bigint")
    made = windows.chunks(df, 3, 20)
    want = windows.shuffle_batches(windows.examples(made, 3), size, 9).collect()
    got = windows.shuffled_examples(made, 3, size, 9)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    key = lambda r: (r.chunk_id, r.batch_id, r.target_pos, r.context, r.target)
    assert sorted(map(key, got.collect())) == sorted(map(key, want))
    members = {}
    for r in want:
        members[r.chunk_id, r.batch_id] = members.get((r.chunk_id, r.batch_id), 0) + 1
    place = {r.target_pos: (r.chunk_id, r.batch_id) for r in want}
    assert all(r.batch_size == members[place[r.target_pos]] for r in got.collect())
    sized = windows.batch_sizes(made, 3, size, 9).collect()
    assert len(sized) == len(want)
    assert all((r.batch_size, r.chunk_id) == (members[place[r.target_pos]], place[r.target_pos][0]) for r in sized)


def test_spans_give_chunks_without_token_rows(spark):
    from tokenloom.operators import vocabulary

    texts = ["a b c", "", None, "d " * 23, "e", "f g"]
    docs = spark.createDataFrame([(i * 7 - 3, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    spans = vocabulary.stream_spans(docs)
    tokens = vocabulary.placed_tokens(docs, vocabulary.stream_starts(docs))
    places = vocabulary.positions(spans)
    assert sorted(map(tuple, places.collect())) == sorted(map(tuple, tokens.select("doc_id", "gpos").collect()))
    assert "token" not in places._jdf.queryExecution().optimizedPlan().toString()
    for context, chunk in ((2, 5), (1, 2), (3, 100), (1, 9)):
        want = {}
        for (at,) in tokens.select("gpos").collect():
            for k in range(1, at + 2):
                if (k - 1) * (chunk - context) <= at < (k - 1) * (chunk - context) + chunk:
                    want.setdefault(k, []).append(at)
        want = sorted((k, len(v) - context, -(-(len(v) - context) // 4), max(v) + 1) for k, v in want.items() if len(v) > context)
        assert sorted(map(tuple, windows.span_stats(spans, context, chunk, 4).collect())) == want
