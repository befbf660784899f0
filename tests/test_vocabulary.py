import random

import pytest

from tokenloom.operators import encoding, vocabulary
from tokenloom.operators.skew import frequent


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def as_dict(vocab):
    return {r.token: r.id for r in vocab.collect()}


def python_vocab(texts, known=None, start=0):
    vocab = dict(known or {})
    nxt = max(vocab.values()) + 1 if vocab else start
    for text in texts:
        for token in text.split():
            if token not in vocab:
                vocab[token] = nxt
                nxt += 1
    return vocab


@pytest.mark.parametrize("start, want", [(0, {"a": 0, "b": 1, "c": 2}), (1, {"a": 1, "b": 2, "c": 3})])
def test_build(spark, start, want):
    assert as_dict(vocabulary.build(docs(spark, ["a b a c"]), start)) == want


def test_extend(spark):
    known = spark.createDataFrame([("x", 5, 1)], "token string, id bigint, n bigint")
    vocab = vocabulary.extend(docs(spark, ["y x z"]), known)
    assert as_dict(vocab) == {"x": 5, "y": 6, "z": 7}
    ids = vocabulary.encode_known(vocabulary.tokenize(docs(spark, ["y x z"])), vocab)
    assert [r.id for r in ids.orderBy("pos").collect()] == [6, 5, 7]


def skewed_texts():
    """One token makes up more than a third of all tokens, one text most of them."""
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 400)}" for _ in range(3000)]
    texts = [" ".join(words[i : i + 3]) + " le le" for i in range(0, 300, 3)]
    return ["", *texts[:40], " ".join(w + " le" for w in words), *texts[40:], "  \n "]


def test_skewed_stream_equals_python(spark):
    texts = skewed_texts()
    df = docs(spark, texts)
    want = python_vocab(texts)
    vocab = vocabulary.build(df).cache()
    assert as_dict(vocab) == want
    stream = [want[t] for text in texts for t in text.split()]
    for share in (0, 1, 50, 10_000):
        hot = frequent(vocab, ["token"], "n", share) if share else None
        known = vocabulary.encode_known(vocabulary.tokenize(df), vocab, hot)
        assert [r.id for r in known.orderBy("doc_id", "pos").collect()] == stream
    for counted in (False, True):
        ids = encoding.encode_stream(df, vocab, counted=counted).collect()
        assert [(r.gpos, r.id) for r in sorted(ids, key=lambda r: r.gpos)] == list(enumerate(stream))


@pytest.mark.parametrize("ids", [[3, 4, 4], [1, None]])
def test_texts_without_an_order_of_their_own_fail(spark, ids):
    df = spark.createDataFrame([(i, "a b") for i in ids], "doc_id bigint, text string")
    with pytest.raises(Exception, match="order key doc_id"):
        vocabulary.build(df).collect()
    with pytest.raises(Exception, match="order key doc_id"):
        encoding.encode_stream(df, vocabulary.build(docs(spark, ["a b"]))).collect()


def test_random_ids_order_the_stream(spark):
    rng = random.Random(8)
    ids = sorted(rng.getrandbits(63) - 2**62 for _ in range(40))
    texts = [f"w{rng.randint(0, 30)} w{rng.randint(0, 30)}" for _ in ids]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").repartition(7)
    assert as_dict(vocabulary.build(df)) == python_vocab(texts)


def test_encode_drops_unknown_and_roundtrip(spark):
    df = docs(spark, ["a b  c", "c\nd"])
    vocab = vocabulary.build(docs(spark, ["c a"]))
    ids = vocabulary.encode_known(vocabulary.tokenize(df), vocab)
    text = {r.doc_id: r.text for r in encoding.decode(ids.select("doc_id", "pos", "id"), vocab).collect()}
    assert text == {0: "a c", 1: "c"}


def test_unknown_tokens_keep_every_occurrence(spark):
    vocab = vocabulary.build(docs(spark, ["a b"]))
    rows = vocabulary.unknown(vocabulary.tokenize(docs(spark, ["a x b x", "c"])), vocab)
    assert sorted((r.doc_id, r.pos, r.token) for r in rows.collect()) == [(0, 1, "x"), (0, 3, "x"), (1, 0, "c")]


def test_next_id_of_empty_and_full(spark):
    empty = spark.createDataFrame([], "token string, id bigint, n bigint")
    assert vocabulary.next_id(empty).first()[0] == 0
    assert vocabulary.next_id(vocabulary.build(docs(spark, ["a b"]), 1)).first()[0] == 3


def test_slots_and_collisions(spark):
    entries = spark.createDataFrame([("a", "1"), ("b", "11"), ("c", "2"), ("d", "x")], "token string, id string")
    numbers = vocabulary.numeric_ids(entries)
    assert {r.slot: r.token for r in vocabulary.slots(numbers, 10).collect()} == {1: "a", 2: "c"}
    assert tuple(vocabulary.collisions(numbers, 10).first()) == (11, 1, True)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        vocabulary.numeric_ids(entries, "fail").collect()


def test_duplicates(spark):
    entries = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "token string, id bigint")
    assert {tuple(r) for r in vocabulary.duplicates(entries).collect()} == {("token", "a", 2), ("id", "2", 2)}


@pytest.mark.parametrize("rows, message", [([("a", 1), ("a", 2)], "token .*: a"), ([("a", 1), ("b", 1), ("c", 2)], "id .*: 1"), ([("a", None)], "id .*: null"), ([(None, 1)], "token .*: null")])
def test_an_import_with_repeats_aborts(spark, rows, message):
    entries = spark.createDataFrame(rows, "token string, id bigint")
    with pytest.raises(Exception, match=message):
        vocabulary.checked(entries).collect()


def test_an_import_without_repeats_is_unchanged(spark):
    rows = [(f"w{i}", i * 3) for i in range(50)]
    entries = spark.createDataFrame([(*r, "x") for r in rows], "token string, id bigint, more string")
    assert sorted((r.token, r.id) for r in vocabulary.checked(entries).collect()) == sorted(rows)
    assert vocabulary.checked(entries.limit(0)).count() == 0


def rows(spark, ids):
    return spark.createDataFrame([(0, p, i) for p, i in enumerate(ids)], "doc_id bigint, pos bigint, id bigint")


def test_phrases_mark_ids_outside_the_table(spark):
    slots = spark.createDataFrame([(1, "a")], "slot bigint, token string")
    got = encoding.to_phrases(rows(spark, [1, 2, 500]), slots, 10).first().phrase
    assert got == "a <unk> <id:500>"
    assert encoding.to_phrases(rows(spark, [1, 500]), None, 10).first().phrase == "1 500"


def test_decode_keeps_inner_spaces(spark):
    entries = spark.createDataFrame([(1, "w1"), (2, "w2")], "id bigint, token string")
    assert encoding.decode(rows(spark, [1, 9, 2]), entries).first().text == "w1  w2"
    assert encoding.decode(rows(spark, [9, 1, 9]), entries).first().text == "w1"


def test_last_entry_of_an_id_wins(spark):
    entries = spark.createDataFrame([(1, "old", 0), (1, "new", 1)], "id bigint, token string, at bigint")
    assert encoding.last_wins(entries, "at").first().token == "new"


def test_tokens_are_counted_by_hash_and_placed_before_they_are_shuffled(spark):
    df = docs(spark, ["a b a", "", "b c"])
    starts = vocabulary.stream_starts(df).checkpoint()
    placed = vocabulary.placed_tokens(df, starts)
    assert sorted((r.gpos, r.token) for r in placed.collect()) == list(enumerate("a b a b c".split()))
    seen = vocabulary.first_seen(placed)
    assert sorted(map(tuple, seen.collect())) == [("a", 0, 2), ("b", 1, 2), ("c", 4, 1)]
    assert "SortAggregate" not in seen._jdf.queryExecution().executedPlan().toString()
    vocab = vocabulary.build(df, starts=starts).checkpoint()
    assert "Generate" not in vocabulary.build(df, starts=starts)._jdf.queryExecution().analyzed().toString()
    plan = encoding.encode_stream(df, vocab, starts=starts).select("gpos", "id")._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner, (token")
    assert "start" not in plan[:join]
