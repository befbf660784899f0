"""Sources, sinks and run metadata (S)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.sequences import as_text
from tokenloom.operators import dialogs, encoding, matching, runs, vocabulary, windows
from tokenloom.plans import inputs as I
from tokenloom.plans.registry import query
from tokenloom.session import scratch_path
from tokenloom.sources import readers, sinks
from tokenloom.streaming import jobs

ID_BATCH = 120_000
MIN_IDS = 5_000


def _raw_dialogs(spark: SparkSession, d: str) -> DataFrame:
    turns = readers.read_table(spark, d, "conversations", "conv_id", "turn", "role", "text")
    return dialogs.dialog_turns(turns)


SQL_DIALOGS = """dia AS (
  SELECT conv_id, turn, text AS prompt, reply AS response FROM (
    SELECT conv_id, turn, role, text,
           lead(role) OVER w AS next_role, lead(text) OVER w AS reply
    FROM conversations WHERE role IN ('user', 'assistant')
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

_WHITELIST = r"""[^a-zA-ZÀ-ÿ0-9.,!?;:''"()\-\s]"""


def sql_clean(text: str, urls: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({text}, '{urls}', '', 'g'), "
        rf"'<.*?>', '', 'g'), '{_WHITELIST}', '', 'g'), '\s+', ' ', 'g'))"
    )


URLS_WEB = r"http\S+|www\S+"
URLS_DIALOG = r"http\S+"

SQL_PAIRS = f"""{SQL_DIALOGS},
pairs AS (
  SELECT * FROM (
    SELECT conv_id, turn, {sql_clean('prompt', URLS_DIALOG)} AS prompt, {sql_clean('response', URLS_DIALOG)} AS response
    FROM dia)
  WHERE length(prompt) > 10 AND length(response) > 10)"""

SQL_WEB = f"""web AS (
  SELECT doc_id, text FROM (
    SELECT doc_id, {sql_clean('text', URLS_WEB)} AS text FROM documents
    WHERE contains(text, ' le ') OR contains(text, ' la '))
  WHERE length(text) >= 50)"""


@query("scan_dialogs", f"WITH {SQL_DIALOGS} SELECT prompt, response FROM dia")
def scan_dialogs(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "dialogs")
    _raw_dialogs(spark, d).select("prompt", "response").write.parquet(path)
    return readers.read_dialogs(spark, path)


@query("scan_web_stream", "SELECT doc_id, text FROM documents")
def scan_web_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = "doc_id bigint, text string"
    path = scratch_path(spark, "web")
    jobs.append_to(readers.read_table_stream(spark, d, "documents", schema), path, scratch_path(spark, "offsets"))
    return spark.read.schema(schema).parquet(path)


@query("scan_labelled_csv", f"WITH {I.LEXICON} SELECT texte, classe, pos_tag FROM lex")
def scan_labelled_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "labelled")
    I.lexicon(spark, d).select("texte", "classe", "pos_tag").write.option("header", True).csv(path)
    return readers.read_labelled(spark, path)


@query(
    "scan_lexicon",
    f"""SELECT word, count(*) AS n FROM (
      SELECT unnest({I.SQL_SPLIT_PHRASE.format('text')}) AS word FROM benchmark) GROUP BY word""",
)
def scan_lexicon(spark: SparkSession, d: str) -> DataFrame:
    """Repeated words stay in the list; the report counts them."""
    path = scratch_path(spark, "lexicon")
    I.phrase_words(I.prompts(spark, d)).select("word").write.csv(path)
    return readers.read_lexicon(spark, path).groupBy("word").agg(F.count("*").alias("n"))


@query("scan_tokens", f"WITH {SQL_WEB}, {I.sql_tokens('wtok', 'web')} SELECT gpos, token FROM wtok")
def scan_tokens(spark: SparkSession, d: str) -> DataFrame:
    """A token file without line ends."""
    path = scratch_path(spark, "tokens")
    words = vocabulary.tokenize(I.web_corpus(I.documents(spark, d)))
    sinks.write_words(words, path, "token", "doc_id", "pos")
    return readers.read_word_stream(spark, path)


@query(
    "scan_token_lines",
    f"""WITH {SQL_WEB}, lines AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line, text FROM web),
{I.sql_tokens('wtok', 'lines', 'line')} SELECT doc_id, pos, token FROM wtok""",
)
def scan_token_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    sinks.write_lines(I.web_corpus(I.documents(spark, d)), path, "text", "doc_id")
    return readers.read_tokens(spark, path)


@query(
    "scan_ids",
    f"WITH {I.DOC_IDS} SELECT gpos // {ID_BATCH} AS line, gpos % {ID_BATCH} AS pos, id % 10000 AS id FROM ids",
)
def scan_ids(spark: SparkSession, d: str) -> DataFrame:
    """An ID file without line ends, and where in which batch each id lies."""
    path = scratch_path(spark, "ids")
    # The ids of a text are written with blanks between them, as each would be alone; only texts are put in order.
    texts, _ = I.own_texts(I.documents(spark, d))
    sinks.write_words(texts.select("gpos", as_text("ids").alias("ids")), path, "ids", "gpos")
    ids = readers.read_id_stream(spark, path, 10_000)
    return ids.select(F.floor(F.col("gpos") / ID_BATCH).alias("line"), (F.col("gpos") % ID_BATCH).alias("pos"), "id")


@query("scan_vocab_json", f"WITH {I.DOC_VOCAB} SELECT token, id FROM voc")
def scan_vocab_json(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "vocab")
    sinks.write_vocab_json(I.vocab_of(I.documents(spark, d)), path)
    return vocabulary.checked(readers.read_vocab_json(spark, path))


@query(
    "sink_corpus_lines",
    f"WITH {SQL_WEB} SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line_id, text AS value FROM web",
)
def sink_corpus_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "corpus")
    sinks.write_lines(I.web_corpus(I.documents(spark, d)), path, "text", "doc_id")
    return readers.read_lines(spark, path)


@query(
    "sink_dialog_text",
    f"WITH {SQL_PAIRS} SELECT 'User: ' || prompt || chr(10) || 'Assistant: ' || response AS value FROM pairs",
)
def sink_dialog_text(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "dialog-text")
    lines = dialogs.dialog_lines(_raw_dialogs(spark, d))
    sinks.write_lines(lines, path, "line", "conv_id", "turn")
    return spark.read.option("lineSep", "\n\n").text(path)


@query(
    "sink_ids",
    f"""WITH {I.DOC_IDS} SELECT gpos // {ID_BATCH} AS line_id, string_agg(id::VARCHAR, ' ' ORDER BY gpos) AS value
FROM ids GROUP BY 1""",
)
def sink_ids(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    texts, _ = I.own_texts(I.documents(spark, d))
    sinks.write_lines(encoding.id_lines_of(texts, ID_BATCH), path, "ids", "line")
    return readers.read_lines(spark, path)


@query("sink_vocab_export", f"WITH {I.DOC_VOCAB} SELECT id AS line_id, token, id FROM voc")
def sink_vocab_export(spark: SparkSession, d: str) -> DataFrame:
    """Export in id order; read back by line, so the order itself is compared."""
    path = scratch_path(spark, "export")
    vocab = I.vocab_of(I.documents(spark, d)).select("id", F.to_json(F.struct("token", "id")).alias("row"))
    sinks.write_lines(vocab, path, "row", "id")
    row = F.from_json("value", "token string, id bigint")
    return readers.read_lines(spark, path).select("line_id", row.alias("r")).select("line_id", "r.*")


SQL_NEW_WORDS = f"""new_words AS (
  SELECT DISTINCT word FROM (SELECT unnest({I.SQL_SPLIT_PHRASE.format('text')}) AS word FROM benchmark)
  WHERE word NOT IN (SELECT texte FROM lex))"""


@query(
    "append_examples",
    f"""WITH {I.LEXICON}, {SQL_NEW_WORDS}
SELECT texte, classe, pos_tag FROM lex UNION ALL SELECT word, 'nouveau', NULL FROM new_words""",
)
def append_examples(spark: SparkSession, d: str) -> DataFrame:
    """Words not in the labelled table are appended without a tag; it is never rewritten."""
    path = scratch_path(spark, "examples")
    lexicon = I.lexicon(spark, d)
    sinks.append_table(lexicon.select("texte", "classe", "pos_tag"), path)
    words = I.phrase_words(I.prompts(spark, d)).select(F.col("word").alias("texte")).distinct()
    new = words.join(lexicon, "texte", "left_anti").withColumn("classe", F.lit("nouveau"))
    sinks.append_table(matching.append_rows(lexicon.select("texte", "classe", "pos_tag").limit(0), new), path)
    return spark.read.parquet(path)


@query(
    "choose_dataset",
    rf"""WITH counts AS (
  SELECT 1 AS priority, 'benchmark' AS name, sum(len(regexp_extract_all(text, '\S+'))) AS n FROM benchmark
  UNION ALL SELECT 2, 'documents', sum(len(regexp_extract_all(text, '\S+'))) FROM documents
  UNION ALL SELECT 3, 'conversations', sum(len(regexp_extract_all(text, '\S+'))) FROM conversations),
report AS (
  SELECT priority, name, least(n, {MIN_IDS})::BIGINT AS n,
         CASE WHEN n < {MIN_IDS} THEN 'too few' ELSE 'ok' END AS reason FROM counts
  UNION ALL SELECT 0, 'missing', 0, 'absent')
SELECT priority, name, n, reason,
       priority = (SELECT min(priority) FROM report WHERE reason = 'ok') AS chosen FROM report""",
)
def choose_dataset(spark: SparkSession, d: str) -> DataFrame:
    names = ["missing", "benchmark", "documents", "conversations"]
    return readers.choose_dataset(spark, [(n, f"{d}/{n}.parquet") for n in names], MIN_IDS)


SQL_STATS = f"""total AS (SELECT max(gpos) + 1 AS n FROM ids),
stats AS (
  SELECT k AS chunk_id,
         least({I.CHUNK}, n - (k - 1) * {I.CHUNK - I.CONTEXT}) - {I.CONTEXT} AS examples,
         least((k - 1) * {I.CHUNK - I.CONTEXT} + {I.CHUNK}, n) AS seen_tokens
  FROM total, unnest(range(1, (n // {I.CHUNK - I.CONTEXT} + 2)::BIGINT)) AS u(k)
  WHERE least({I.CHUNK}, n - (k - 1) * {I.CHUNK - I.CONTEXT}) > {I.CONTEXT})"""


@query(
    "run_metadata",
    f"""WITH {I.DOC_IDS}, {SQL_STATS}
SELECT (SELECT count(*) FROM voc) AS vocab_size, {I.EMB_DIM}::BIGINT AS emb_dim, {I.HIDDEN_DIM}::BIGINT AS hidden_dim,
       {I.CONTEXT}::BIGINT AS context_size, 1::BIGINT AS epoch, chunk_id AS chunk_index, seen_tokens FROM stats""",
)
def run_metadata(spark: SparkSession, d: str) -> DataFrame:
    docs = I.documents(spark, d)
    # Only the size of the vocabulary is asked for, so nothing is numbered.
    vocab = vocabulary.tokenize(docs).select("token").distinct()
    stats = windows.span_stats(vocabulary.stream_spans(docs), I.CONTEXT, I.CHUNK, I.BATCH)
    return runs.run_metadata(stats, vocab, I.CONTEXT, I.EMB_DIM, I.HIDDEN_DIM, 1)


@query(
    "check_metadata",
    rf"""WITH s AS (
  SELECT count(DISTINCT token) AS vocab_size, count(*) AS seen_tokens
  FROM (SELECT unnest(regexp_extract_all(text, '\S+')) AS token FROM benchmark)),
c AS (
  SELECT count(DISTINCT token) AS vocab_size, count(*) AS seen_tokens
  FROM (SELECT unnest(regexp_extract_all(text, '\S+')) AS token FROM documents)),
kv AS (
  SELECT 'vocab_size' AS k, s.vocab_size AS a, c.vocab_size AS b FROM s, c
  UNION ALL SELECT 'seen_tokens', s.seen_tokens, c.seen_tokens FROM s, c
  UNION ALL SELECT 'context_size', {I.CONTEXT}, {I.CONTEXT}
  UNION ALL SELECT 'emb_dim', NULL, {I.EMB_DIM})
SELECT count(*) AS n, coalesce(string_agg(k || ': ckpt=' || coalesce(a::VARCHAR, 'None') || ' vs actuel=' || b, ' | ' ORDER BY k), '') AS report
FROM kv WHERE a IS DISTINCT FROM b""",
)
def check_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The saved table lacks one key, which counts as a difference."""

    def sizes(docs: DataFrame, *more: str) -> DataFrame:
        seen = vocabulary.tokenize(docs).groupBy("token").agg(F.count("*").alias("n"))
        meta = seen.agg(F.count("*").alias("vocab_size"), F.sum("n").alias("seen_tokens"))
        meta = meta.withColumn("context_size", F.lit(I.CONTEXT)).withColumn("emb_dim", F.lit(I.EMB_DIM))
        return runs.key_values(meta, ("vocab_size", "seen_tokens", "context_size", *more))

    return runs.check_metadata(sizes(I.prompts(spark, d)), sizes(I.documents(spark, d), "emb_dim"))
