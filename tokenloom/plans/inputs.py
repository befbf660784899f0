"""Inputs that several plans share, each in its Spark form and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import clean_web, is_french, is_long_enough, split_phrase
from tokenloom.operators import blocks, vocabulary
from tokenloom.operators.order import dense_index, exclusive_sum, token_starts
from tokenloom.session import materialize
from tokenloom.sources.readers import read_table, spread

# Work sizes of the smallest configuration.
CONTEXT, CHUNK, BATCH = 8, 5000, 2
EMB_DIM, HIDDEN_DIM = 64, 128
SEED = 42
ORDER = 3
TURN_BITS = 16  # 65,536 turns are numbered together


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "documents", "doc_id", "text"), "doc_id")


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "benchmark", F.col("item_id").alias("doc_id"), "text")


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of conversations as texts, numbered 0, 1, 2, ... by conversation and turn.

    A conversation starts at the number of turns before it. Its turns are numbered in blocks, so an endless one is many groups.
    """
    rows = spread(read_table(spark, folder, "conversations", "conv_id", "turn", "text"), "conv_id")
    keys = rows.select("conv_id", F.shiftright("turn", TURN_BITS).alias("_block"))
    blocks = keys.groupBy("conv_id", "_block").agg(F.count("*").alias("_n"))
    sizes = blocks.groupBy("conv_id").agg(F.sum("_n").alias("_all"))
    earlier = exclusive_sum(sizes, "conv_id", "_all", "_begin").select("conv_id", "_begin")
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_inside", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(earlier, "conv_id")
    starts = starts.select("conv_id", "_block", (F.col("_begin") + F.col("_inside")).alias("_start"))
    numbered = rows.withColumn("_block", F.shiftright("turn", TURN_BITS))
    place = F.row_number().over(Window.partitionBy("conv_id", "_block").orderBy("turn"))
    numbered = numbered.withColumn("_place", place).join(starts, ["conv_id", "_block"])
    return numbered.select((F.col("_start") + F.col("_place") - 1).alias("doc_id"), "text")


def web_corpus(docs: DataFrame) -> DataFrame:
    """Raw French test, cleaning, length test. The cheap filter runs on the raw text first."""
    cleaned = docs.filter(is_french("text")).withColumn("text", clean_web("text"))
    return cleaned.filter(is_long_enough("text"))


def vocab_of(docs: DataFrame, start: int = 0) -> DataFrame:
    return materialize(vocabulary.build(docs, start))


def own_blocks(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Blocks of the words of ``docs``, where their texts lie in the stream, and their own vocabulary, all stored."""
    made = blocks.word_blocks(docs)
    placed = blocks.spans(made)
    return made, placed, blocks.vocabulary(made, placed)


def own_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ids of the texts of ``docs`` (see ``blocks.encode``) and their own vocabulary."""
    made, placed, vocab = own_blocks(docs)
    return blocks.encode(made, placed, vocab), vocab


def own_stream(docs: DataFrame) -> DataFrame:
    """The ID stream of ``docs``, a row per token."""
    return blocks.rows(own_texts(docs)[0])


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled words: the words of the labelled documents, numbered by first use.

    A word's class is the language it is most used in, its tag the quality label it is most used
    with; ties go to the smaller value.
    """
    labels = read_table(spark, folder, "labels", "doc_id", "quality")
    docs = read_table(spark, folder, "documents", "doc_id", "text", "lang")
    docs = spread(docs, "doc_id").join(labels, "doc_id").withColumn("words", split_phrase("text"))
    starts = token_starts(docs, "doc_id", "words").select("doc_id", "start")
    placed = docs.join(starts, "doc_id").select("lang", "quality", "start", F.posexplode("words").alias("pos", "texte"))
    # All that is asked of a word is kept per word, language and quality: its uses and its first place. Stored, as three plans read it.
    uses = placed.groupBy("texte", "lang", "quality").agg(
        F.count("*").alias("n"), F.min(F.col("start") + F.col("pos")).alias("gpos")
    )
    uses = materialize(uses)

    def most_used(value: str, name: str) -> DataFrame:
        sums = uses.groupBy("texte", value).agg(F.sum("n").alias("n"))
        return sums.groupBy("texte").agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(name))

    firsts = uses.groupBy("texte").agg(F.min("gpos").alias("gpos"))
    known = firsts.join(most_used("lang", "classe"), "texte").join(most_used("quality", "_q"), "texte")
    rows = dense_index(materialize(known), "gpos", "row_id", key_bits=48)
    tag = F.concat(F.lit("q"), F.col("_q").cast("string")).alias("pos_tag")
    return materialize(rows.select("row_id", "texte", "classe", tag))


def phrase_words(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.explode(split_phrase("text")).alias("word"))


# SQL texts -------------------------------------------------------------------------------


def sql_tokens(name: str, table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTE ``name(doc_id, pos, token, gpos)``."""
    return rf"""{name}_raw AS (
  SELECT {key} AS doc_id, list_filter(string_split_regex({text}, '\s+'), lambda x: x <> '') AS t
  FROM {table}),
{name}_rows AS (
  SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM {name}_raw),
{name} AS (
  SELECT doc_id, pos, token, row_number() OVER (ORDER BY doc_id, pos) - 1 AS gpos
  FROM {name}_rows)"""


def sql_vocab(name: str, tokens: str, start: int = 0) -> str:
    """CTE ``name(token, id)`` by first use in ``tokens``."""
    return f"""{name} AS (
  SELECT token, row_number() OVER (ORDER BY min(gpos)) - 1 + {start} AS id FROM {tokens} GROUP BY token)"""


def sql_ids(name: str, tokens: str, vocab: str) -> str:
    return f"""{name} AS (
  SELECT doc_id, pos, gpos, id FROM {tokens} JOIN {vocab} USING (token))"""


DOC_TOKENS = sql_tokens("tok")
DOC_VOCAB = f"{DOC_TOKENS},\n{sql_vocab('voc', 'tok')}"
DOC_IDS = f"{DOC_VOCAB},\n{sql_ids('ids', 'tok', 'voc')}"
PROMPT_TOKENS = sql_tokens("ptok", "benchmark", "item_id")
TURNS = "(SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS doc_id, text FROM conversations)"
TURN_TOKENS = sql_tokens("ttok", TURNS)

SQL_SPLIT_PHRASE = (
    "list_filter(string_split(regexp_replace(lower({0}), '[^a-zA-Z0-9éèàùç ]', ' ', 'g'), ' '), lambda x: x <> '')"
)

LEXICON = f"""lex_docs AS (
  SELECT d.doc_id, d.lang, l.quality, {SQL_SPLIT_PHRASE.format('d.text')} AS w
  FROM documents d JOIN labels l USING (doc_id)),
lex_uses AS (
  SELECT doc_id, lang, quality, unnest(range(len(w))) AS pos, unnest(w) AS texte FROM lex_docs),
lex_first AS (
  SELECT texte, row_number() OVER (ORDER BY min((doc_id, pos))) - 1 AS row_id FROM lex_uses GROUP BY texte),
lex_lang AS (
  SELECT texte, lang FROM (SELECT texte, lang, count(*) AS n FROM lex_uses GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY texte ORDER BY n DESC, lang) = 1),
lex_quality AS (
  SELECT texte, quality FROM (SELECT texte, quality, count(*) AS n FROM lex_uses GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY texte ORDER BY n DESC, quality) = 1),
lex AS (
  SELECT row_id, texte, lang AS classe, 'q' || quality AS pos_tag
  FROM lex_first JOIN lex_lang USING (texte) JOIN lex_quality USING (texte))"""
