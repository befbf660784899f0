"""Chunks, windows, batches and their reports (W, A)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.sequences import as_text
from tokenloom.operators import nexttoken, runs, vocabulary, windows
from tokenloom.plans import inputs as I
from tokenloom.plans.registry import query
from tokenloom.plans.scans import SQL_STATS
from tokenloom.session import materialize
from tokenloom.sources.readers import read_table

TOKEN_LIMIT = 100_000
STEP = I.CHUNK - I.CONTEXT


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return windows.chunks_of(I.own_texts(I.documents(spark, d))[0], I.CONTEXT, I.CHUNK)


def spans(spark: SparkSession, d: str) -> DataFrame:
    """Where the documents lie in the stream."""
    return vocabulary.stream_spans(I.documents(spark, d))


def examples(spark: SparkSession, d: str, keep: int | None = None) -> DataFrame:
    return windows.examples(chunks(spark, d), I.CONTEXT, keep)


SQL_EXAMPLES = f"""{I.DOC_IDS},
ex AS (
  SELECT (gpos - {I.CONTEXT}) // {STEP} + 1 AS chunk_id, gpos AS target_pos, id AS target,
         string_agg(id::VARCHAR, ' ') OVER (ORDER BY gpos ROWS BETWEEN {I.CONTEXT} PRECEDING AND 1 PRECEDING) AS context,
         lag(id, 1) OVER (ORDER BY gpos) AS a1, lag(id, 2) OVER (ORDER BY gpos) AS a2, lag(id, 3) OVER (ORDER BY gpos) AS a3
  FROM ids QUALIFY gpos >= {I.CONTEXT})"""

# The same examples without the full context, for plans that need its last ids only.
SQL_SHORT = f"""{I.DOC_IDS},
ex AS (
  SELECT (gpos - {I.CONTEXT}) // {STEP} + 1 AS chunk_id, gpos AS target_pos, id AS target,
         lag(id, 1) OVER w AS a1, lag(id, 2) OVER w AS a2, lag(id, 3) OVER w AS a3
  FROM ids WINDOW w AS (ORDER BY gpos) QUALIFY gpos >= {I.CONTEXT})"""

SQL_BATCHES = f"""{SQL_SHORT},
batched AS (
  SELECT *, (row_number() OVER (PARTITION BY chunk_id ORDER BY md5(target_pos || ':{I.SEED}'), target_pos) - 1)
         // {I.BATCH} AS batch_id FROM ex)"""


@query("global_position", f"WITH {I.DOC_IDS} SELECT doc_id, pos, gpos, id FROM ids")
def global_position(spark: SparkSession, d: str) -> DataFrame:
    docs = I.documents(spark, d)
    return I.own_stream(docs)


@query("token_budget", f"WITH {I.DOC_IDS} SELECT gpos, id FROM ids WHERE gpos < {TOKEN_LIMIT}")
def token_budget(spark: SparkSession, d: str) -> DataFrame:
    docs = I.documents(spark, d)
    stream = I.own_stream(docs)
    return windows.token_budget(stream, TOKEN_LIMIT).select("gpos", "id")


@query(
    "chunk_assign",
    f"""WITH {I.DOC_TOKENS}, n AS (SELECT count(*) AS n FROM tok)
SELECT k AS chunk_id, gpos FROM tok, n,
  unnest(range(greatest(gpos // {STEP} - 1, 1)::BIGINT, (gpos // {STEP} + 2)::BIGINT)) AS u(k)
WHERE gpos >= (k - 1) * {STEP} AND gpos < (k - 1) * {STEP} + {I.CHUNK}""",
)
def chunk_assign(spark: SparkSession, d: str) -> DataFrame:
    return windows.chunk_assign(vocabulary.positions(spans(spark, d)), I.CONTEXT, I.CHUNK).select("chunk_id", "gpos")


@query(
    "chunk_windows",
    f"""WITH {I.DOC_IDS}, {SQL_STATS}, c AS (
  SELECT s.chunk_id, s.examples, (s.chunk_id - 1) * {STEP} AS start, s.seen_tokens - 1 AS stop FROM stats s)
SELECT chunk_id, start, examples + {I.CONTEXT} AS tokens, md5(string_agg(id::VARCHAR, ' ' ORDER BY gpos)) AS digest
FROM c JOIN ids ON gpos BETWEEN start AND stop GROUP BY 1, 2, 3""",
)
def chunk_windows(spark: SparkSession, d: str) -> DataFrame:
    made = chunks(spark, d)
    return made.select(
        "chunk_id", "start", F.size("ids").cast("bigint").alias("tokens"), F.md5(as_text("ids")).alias("digest")
    )


@query("context_windows", f"WITH {SQL_EXAMPLES} SELECT chunk_id, target_pos, context, target FROM ex")
def context_windows(spark: SparkSession, d: str) -> DataFrame:
    return examples(spark, d).withColumn("context", as_text("context"))


@query("shuffle_batches", f"WITH {SQL_BATCHES} SELECT chunk_id, batch_id, target_pos, target FROM batched")
def shuffle_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.shuffled_examples(chunks(spark, d), I.CONTEXT, I.BATCH, I.SEED, keep=1)
    return rows.select("chunk_id", "batch_id", "target_pos", "target")


@query(
    "chunk_stats",
    f"""WITH {I.DOC_IDS}, {SQL_STATS}
SELECT chunk_id, examples, (examples + {I.BATCH - 1}) // {I.BATCH} AS batches, seen_tokens FROM stats""",
)
def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    return windows.span_stats(spans(spark, d), I.CONTEXT, I.CHUNK, I.BATCH)


@query(
    "series_mean",
    """SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, (count(*) - 1) / 2.0::DOUBLE AS index_mean
FROM events GROUP BY event_type""",
)
def series_mean(spark: SparkSession, d: str) -> DataFrame:
    events = read_table(spark, d, "events", "event_type", "value")
    return runs.series_mean(events, "event_type", "value").withColumn("mean", F.round("mean", 6))


# Loss reports -----------------------------------------------------------------------------

SQL_LOSSES = f"""{SQL_BATCHES},
pairs AS (SELECT a1, target, count(*) AS cnt FROM ex GROUP BY 1, 2),
after AS (SELECT a1, sum(cnt) AS total FROM pairs GROUP BY 1),
targets AS (SELECT count(DISTINCT target) AS v FROM ex),
losses AS (
  SELECT chunk_id, batch_id, target_pos, -ln((cnt + 1.0) / (total + v)) AS loss
  FROM batched JOIN pairs USING (a1, target) JOIN after USING (a1), targets)"""


def sized(spark: SparkSession, d: str) -> DataFrame:
    return windows.batch_sizes(materialize(chunks(spark, d)), I.CONTEXT, I.BATCH, I.SEED, keep=1)


@query(
    "cross_entropy",
    f"""WITH {SQL_LOSSES}
SELECT chunk_id, count(*) AS examples, round(avg(loss), 6) AS cross_entropy FROM losses GROUP BY chunk_id""",
)
def cross_entropy(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.examples(materialize(chunks(spark, d)), I.CONTEXT, keep=1)
    report = nexttoken.group_losses(rows, "chunk_id")
    return report.withColumn("cross_entropy", F.round("cross_entropy", 6))


@query(
    "epoch_mean_loss",
    f"""WITH {SQL_LOSSES}, b AS (SELECT avg(loss) AS l FROM losses GROUP BY chunk_id, batch_id)
SELECT count(*) AS batches, round(coalesce(avg(l), 0), 6) AS mean_loss FROM b""",
)
def epoch_mean_loss(spark: SparkSession, d: str) -> DataFrame:
    rows = nexttoken.batch_losses(sized(spark, d))
    return rows.withColumn("mean_loss", F.round("mean_loss", 6))


@query(
    "epoch_report",
    f"""WITH {SQL_LOSSES}, b AS (SELECT chunk_id, batch_id, avg(loss) AS l FROM losses GROUP BY chunk_id, batch_id)
SELECT 1::BIGINT AS epoch, chunk_id, count(*) AS batches, round(avg(l), 6) AS mean_loss FROM b GROUP BY chunk_id""",
)
def epoch_report(spark: SparkSession, d: str) -> DataFrame:
    rows = nexttoken.batch_losses(sized(spark, d).withColumn("epoch", F.lit(1).cast("bigint")), "epoch", "chunk_id")
    return rows.withColumn("mean_loss", F.round("mean_loss", 6))
