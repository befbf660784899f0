import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tokenloom.operators import nexttoken, windows


def stream(n=400, words=9, seed=3):
    rng = random.Random(seed)
    return [0 if rng.random() < 0.4 else rng.randrange(words) for _ in range(n)]


def made(spark, ids, context=4, chunk=50):
    df = spark.createDataFrame(list(enumerate(ids)), "gpos bigint, id bigint")
    return windows.examples(windows.chunks(df, context, chunk), context)


def python_best(ids, context=4, order=3):
    counts = {n: {} for n in range(order + 1)}
    for p in range(context, len(ids)):
        for n in range(order + 1):
            counts[n].setdefault(tuple(ids[p - n : p]), Counter())[ids[p]] += 1
    return {n: {c: min(t, key=lambda x: (-t[x], x)) for c, t in table.items()} for n, table in counts.items()}


def python_next(best, context, order=3):
    for n in range(min(order, len(context)), -1, -1):
        key = tuple(context[len(context) - n :])
        if key in best[n]:
            return best[n][key], n
    raise AssertionError


def test_prediction_backs_off(spark):
    ids = stream()
    counts = nexttoken.ngram_counts(made(spark, ids))
    table, top = nexttoken.best_next(counts), nexttoken.last_resort(counts)
    best = python_best(ids)
    asked = [ids[5:9], [1, 77, 0], [99, 98, 97], [3], [5, 2], [77], []]
    df = spark.createDataFrame([(c,) for c in asked], "context array<bigint>")
    got = {tuple(r.context): (r.predicted, r.n) for r in nexttoken.predict(df, table, top).collect()}
    assert got == {tuple(c[-3:]): python_next(best, c[-3:]) for c in asked}


def test_generation_equals_a_loop(spark):
    ids = stream()
    counts = nexttoken.ngram_counts(made(spark, ids)).cache()
    table, top = nexttoken.best_next(counts).cache(), nexttoken.last_resort(counts)
    followers, buckets = nexttoken.bucketed(table, table.count(), bucket_rows=20)
    assert buckets > 5 and followers.count() == table.count()
    best = python_best(ids)
    prompts = [(0, ids[:6]), (1, ids[:6]), (2, [1, 2, 88]), (3, [4])]
    want = {}
    for number, context in prompts:
        context, out = list(context), []
        for _ in range(6):
            out.append(python_next(best, context[-3:])[0])
            context.append(out[-1])
        want[number] = out
    df = spark.createDataFrame(prompts, "prompt_id bigint, context array<bigint>")
    for few in (0, 1000):
        got = nexttoken.generate(df, followers, buckets, top, 6, few=few).collect()
        assert {r.prompt_id: r.generated for r in got} == want


def test_a_step_opens_only_the_buckets_asked_for(spark):
    table = spark.range(4000).selectExpr("array(id) AS context", "1 AS n", "id + 1 AS next_id")
    followers, buckets = nexttoken.bucketed(table, 4000, bucket_rows=100)
    assert buckets == 40
    numbers = table.filter("next_id IN (8, 9)").select(nexttoken.bucket_of("context", buckets).alias("b")).collect()
    opened = followers.filter(F.col("_bucket").isin([r.b for r in numbers]))
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan
    assert len(opened.inputFiles()) <= 40 and len({r._bucket for r in opened.select("_bucket").distinct().collect()}) <= 2
    top = spark.createDataFrame([(-1,)], "next_id bigint")
    prompts = spark.createDataFrame([(5, [7])], "prompt_id bigint, context array<bigint>")
    assert nexttoken.generate(prompts, followers, buckets, top, 20).first().generated == list(range(8, 28))


def test_loss_and_batch_means(spark):
    ids = stream(120)
    rows = made(spark, ids)
    counts = nexttoken.ngram_counts(rows, 1)
    losses = nexttoken.example_losses(windows.shuffle_batches(rows, 8, 1), counts).collect()
    pairs = Counter(zip(ids[3:], ids[4:]))
    after = Counter()
    for (a, _), c in pairs.items():
        after[a] += c
    targets = len(set(ids[4:]))
    batches = {}
    for r in losses:
        a, t = r.context[-1], r.target
        want = -math.log((pairs[(a, t)] + 1) / (after[a] + targets))
        assert abs(r.loss - want) < 1e-12
        batches.setdefault((r.chunk_id, r.batch_id), []).append(want)
    assert len(losses) == len(ids) - 4
    mean = sum(sum(b) / len(b) for b in batches.values()) / len(batches)
    table = spark.createDataFrame(losses)
    got = nexttoken.batch_mean_loss(table).first()
    assert got.batches == len(batches) and abs(got.mean_loss - mean) < 1e-9
    assert nexttoken.batch_mean_loss(table.limit(0)).first().mean_loss == 0.0


def test_unseen_pairs_and_contexts_have_a_loss(spark):
    counts = nexttoken.ngram_counts(spark.createDataFrame([([1], 2)], "context array<bigint>, target bigint"), 1)
    new = spark.createDataFrame([([1], 5), ([9], 2)], "context array<bigint>, target bigint")
    got = {r.target: r.loss for r in nexttoken.example_losses(new, counts).collect()}
    assert abs(got[5] - math.log(2)) < 1e-12 and got[2] == 0.0


def test_hot_join_loses_and_repeats_nothing(spark):
    """One key holds most rows; the broadcast part may be empty, partial or everything."""
    from tokenloom.operators.skew import hot_join

    rows = spark.createDataFrame([(i, 0 if i % 3 else i % 50) for i in range(600)], "i bigint, k bigint")
    table = rows.groupBy("k").count().filter("k <> 9").selectExpr("k", "k * 10 AS v", "count AS uses")
    want = sorted((r.i, r.k, r.k * 10) for r in rows.collect() if r.k != 9)
    for limit in (0, 1, 5, 1000):
        got = hot_join(rows, table, ["k"], "uses", share=limit).select("i", "k", "v").collect()
        assert sorted(map(tuple, got)) == want


def test_group_means_equal_example_losses(spark):
    rows = made(spark, stream(300)).cache()
    got = {r.chunk_id: (r.examples, r.cross_entropy) for r in nexttoken.group_losses(rows, "chunk_id").collect()}
    want = {}
    for r in nexttoken.example_losses(rows).collect():
        want.setdefault(r.chunk_id, []).append(r.loss)
    assert got.keys() == want.keys()
    for chunk, losses in want.items():
        assert got[chunk][0] == len(losses) and abs(got[chunk][1] - sum(losses) / len(losses)) < 1e-9


def test_a_frequent_key_is_dealt_to_its_parts(spark):
    from tokenloom.operators.skew import frequent, spread_join

    rows = spark.range(9000).selectExpr("id AS i", "IF(id % 3 = 0, id, 7) AS k")
    counts = rows.groupBy("k").count()
    hot = frequent(counts, ["k"], "count", share=30)
    assert [r._parts for r in hot.collect()] == [20]
    table = counts.selectExpr("k", "k * 2 AS v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(rows, table, ["k"], hot=hot)
        assert "_salt" not in joined.columns and joined.filter("v = 2 * k").count() == 9000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Range (0, 9000") == plan.count("Range (0, 9000, step=1") and "_salt" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_planned_once(spark, tmp_path):
    """A text table that is encoded is scanned once, whatever its keys."""
    from tokenloom.operators import encoding, vocabulary

    path = str(tmp_path / "texts")
    spark.createDataFrame([(i, f"le {i} le") for i in range(50)], "doc_id bigint, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    starts = vocabulary.stream_starts(docs).checkpoint()
    vocab = vocabulary.build(docs, starts=starts).checkpoint()
    for frame in (vocabulary.encode_known(vocabulary.tokenize(docs), vocab), encoding.encode_stream(docs, vocab, counted=True, starts=starts), vocabulary.unknown(vocabulary.tokenize(docs), vocab)):
        assert frame._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1


def test_split_join_keeps_or_drops_what_the_table_lacks(spark):
    from tokenloom.operators.skew import frequent, spread_join

    rows = spark.createDataFrame([(i, i % 7 if i % 2 else 0) for i in range(400)], "i bigint, k bigint")
    table = spark.createDataFrame([(0, "a"), (3, "b")], "k bigint, v string")
    for share in (0, 3, 1000):
        hot = frequent(rows.groupBy("k").agg(F.count("*").alias("_n")), ["k"], "_n", share) if share else None
        left = spread_join(rows, table, ["k"], "left", hot).select("i", "k", "v").collect()
        assert sorted((r.i, r.k, r.v or "") for r in left) == sorted((r.i, r.k, {0: "a", 3: "b"}.get(r.k, "")) for r in rows.collect())
        anti = spread_join(rows, table.select("k"), ["k"], "left_anti", hot).collect()
        assert sorted(r.i for r in anti) == sorted(r.i for r in rows.collect() if r.k not in (0, 3))


def test_batch_losses_equal_means_of_batches(spark):
    df = spark.createDataFrame(list(enumerate(stream(333))), "gpos bigint, id bigint")
    chunked = windows.chunks(df, 4, 50).cache()
    for size in (2, 5):
        losses = nexttoken.example_losses(windows.shuffle_batches(windows.examples(chunked, 4), size, 1))
        sized = windows.batch_sizes(chunked, 4, size, 1, keep=1)
        for groups in ((), ("chunk_id",)):
            want = nexttoken.batch_mean_loss(losses, *groups).collect()
            got = nexttoken.batch_losses(sized, *groups).collect()
            name = lambda r: tuple(r[g] for g in groups)
            assert sorted((name(r), r.batches, round(r.mean_loss, 9)) for r in got) == sorted((name(r), r.batches, round(r.mean_loss, 9)) for r in want)
    none = nexttoken.batch_losses(sized.limit(0)).first()
    assert (none.batches, none.mean_loss) == (0, 0.0)


def test_the_most_frequent_target_is_the_last_resort(spark):
    rows = made(spark, stream())
    assert nexttoken.most_frequent(rows).collect() == nexttoken.last_resort(nexttoken.ngram_counts(rows)).collect()
