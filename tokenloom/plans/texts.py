"""Text functions and filters (P), row budgets over texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as X
from tokenloom.functions.sequences import word_ngrams
from tokenloom.operators import dialogs
from tokenloom.operators.order import byte_budget
from tokenloom.operators.vocabulary import tokenize
from tokenloom.plans import inputs as I
from tokenloom.plans.registry import query
from tokenloom.plans.scans import (
    _WHITELIST,
    SQL_DIALOGS,
    SQL_PAIRS,
    SQL_WEB,
    URLS_DIALOG,
    URLS_WEB,
    _raw_dialogs,
    sql_clean,
)
from tokenloom.sources.readers import read_table, spread

BYTE_LIMIT = 200_000


def _pages(spark: SparkSession, d: str, step: Column) -> DataFrame:
    pages = spread(read_table(spark, d, "pages", "page_id", "html"), "page_id")
    return pages.select("page_id", step.alias("text"))


def _sql_pages(step: str) -> str:
    return f"SELECT page_id, {step} AS text FROM pages"


@query("strip_urls_web", _sql_pages(f"regexp_replace(html, '{URLS_WEB}', '', 'g')"))
def strip_urls_web(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, X.strip_urls_web("html"))


@query("strip_urls_dialog", _sql_pages(f"regexp_replace(html, '{URLS_DIALOG}', '', 'g')"))
def strip_urls_dialog(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, X.strip_urls_dialog("html"))


@query("strip_tags", _sql_pages("regexp_replace(html, '<.*?>', '', 'g')"))
def strip_tags(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, X.strip_tags("html"))


@query("char_whitelist", _sql_pages(f"regexp_replace(html, '{_WHITELIST}', '', 'g')"))
def char_whitelist(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, X.char_whitelist("html"))


@query("squeeze_ws", _sql_pages(r"trim(regexp_replace(html, '\s+', ' ', 'g'))"))
def squeeze_ws(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, X.squeeze_ws("html"))


@query("nfkc", "SELECT doc_id, nfc_normalize(text) AS text FROM documents")
def nfkc(spark: SparkSession, d: str) -> DataFrame:
    """DuckDB has NFC only; the two agree where, as here, no compatibility characters occur."""
    docs = I.documents(spark, d)
    return docs.select("doc_id", X.nfkc("text").alias("text"))


@query("clean_web", _sql_pages(sql_clean("html", URLS_WEB)))
def clean_web(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, X.clean_web("html"))


@query("clean_dialog", f"SELECT conv_id, turn, {sql_clean('text', URLS_DIALOG)} AS text FROM conversations")
def clean_dialog(spark: SparkSession, d: str) -> DataFrame:
    turns = spread(read_table(spark, d, "conversations", "conv_id", "turn", "text"), "conv_id")
    return turns.select("conv_id", "turn", X.clean_dialog("text").alias("text"))


@query(
    "filter_french",
    "SELECT doc_id, text FROM documents WHERE contains(text, ' le ') OR contains(text, ' la ')",
)
def filter_french(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents", "doc_id", "text").filter(X.is_french("text"))


@query("filter_min_len", f"SELECT * FROM ({_sql_pages(sql_clean('html', URLS_WEB))}) WHERE length(text) >= 50")
def filter_min_len(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, X.clean_web("html")).filter(X.is_long_enough("text"))


@query("dialog_turns", f"WITH {SQL_DIALOGS} SELECT conv_id, turn, prompt, response FROM dia")
def dialog_turns(spark: SparkSession, d: str) -> DataFrame:
    return _raw_dialogs(spark, d)


@query("dialog_pairs", f"WITH {SQL_PAIRS} SELECT conv_id, turn, prompt, response FROM pairs")
def dialog_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dialogs.dialog_pairs(_raw_dialogs(spark, d))


@query("split_phrase", f"SELECT doc_id, array_to_string({I.SQL_SPLIT_PHRASE.format('text')}, ' ') AS words FROM documents")
def split_phrase(spark: SparkSession, d: str) -> DataFrame:
    docs = I.documents(spark, d)
    return docs.select("doc_id", F.array_join(X.split_phrase("text"), " ").alias("words"))


@query(
    "compress_id",
    "SELECT event_id, (event_id * 7919 - 300) % 1000 + CASE WHEN (event_id * 7919 - 300) % 1000 < 0 THEN 1000 ELSE 0 END AS id FROM events",
)
def compress_id(spark: SparkSession, d: str) -> DataFrame:
    events = read_table(spark, d, "events", "event_id")
    return events.select("event_id", X.compress_id(F.col("event_id") * 7919 - 300, 1000).alias("id"))


@query(
    "word_ngrams",
    f"""WITH w AS (SELECT item_id, {I.SQL_SPLIT_PHRASE.format('text')} AS w FROM benchmark),
g AS (
  SELECT item_id, n, unnest(list_transform(range(1, (len(w) - n + 2)::BIGINT),
         lambda i: array_to_string(w[i:i + n - 1], ' '))) AS term
  FROM w, (VALUES (1), (2), (3)) v(n))
SELECT item_id, term, count(*) AS n FROM g GROUP BY 1, 2""",
)
def ngrams(spark: SparkSession, d: str) -> DataFrame:
    items = read_table(spark, d, "benchmark", "item_id", "text")
    terms = items.select("item_id", F.explode(word_ngrams(X.split_phrase("text"))).alias("term"))
    return terms.groupBy("item_id", "term").agg(F.count("*").alias("n"))


@query(
    "byte_budget",
    f"""WITH {SQL_WEB} SELECT doc_id, text FROM (
  SELECT doc_id, text, sum(strlen(text)) OVER (ORDER BY doc_id) - strlen(text) AS before FROM web)
WHERE before < {BYTE_LIMIT}""",
)
def byte_budget_query(spark: SparkSession, d: str) -> DataFrame:
    sized = I.web_corpus(I.documents(spark, d)).withColumn("bytes", X.utf8_bytes("text"))
    return byte_budget(sized, "doc_id", "bytes", BYTE_LIMIT).select("doc_id", "text")


@query(
    "web_token_report",
    f"""WITH {SQL_WEB}, {I.sql_tokens('wtok', 'web')}
SELECT token, count(*) AS n FROM wtok GROUP BY token ORDER BY n DESC, token LIMIT 20""",
)
def web_token_report(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: web texts, cleaned and tokenized, and their most used tokens."""
    tokens = tokenize(I.web_corpus(I.documents(spark, d)))
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "token").limit(20)
