"""The registered queries of this folder: contract columns from the operators' own results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import (
    chunks,
    jaccard,
    langid,
    middle,
    mixing,
    packing,
    quality,
    secrets,
    shards,
    suffixes,
    topk,
    toxicity,
    tries,
)
from tokenloom.llm.common import crc32_bucket, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def tokenizer_path() -> str:
    """The vocabulary file of the box; the operator itself takes any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_top_k", topk.SQL)
def nearest(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"))


@query("op2_quality_rules", quality.SQL)
def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op3_secret_scan")
def secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, d, "documents")))


@query("op4_packing")
def packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), tokenizer_path(), with_ids=False)


@query("op5_chunk_dedup")
def chunk_dedup(spark: SparkSession, d: str) -> DataFrame:
    return chunks.digest(chunks.dedup(table(spark, d, "documents")))


@query("op6_language_id")
def language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    found = langid.identify(docs, langid.fit(docs))
    held = (crc32_bucket("doc_id", langid.FOLDS) == langid.HELD_OUT).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score")


@query("op7_toxicity")
def toxic(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, d, "labels")))
    held = (crc32_bucket("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted")


@query("op8_jaccard_join")
def jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.join(table(spark, d, "documents")).drop("_row")


@query("op9_mixing", mixing.SQL)
def mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).drop("source")


@query("op10_suffix_dedup")
def suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return chunks.digest(suffixes.dedup(table(spark, d, "documents")))


@query("op11_prefix_trie", tries.SQL)
def trie(spark: SparkSession, d: str) -> DataFrame:
    return tries.prefix_trie(table(spark, d, "conversations"))


@query("op12_kd_sharding")
def sharded(spark: SparkSession, d: str) -> DataFrame:
    return shards.digest(shards.shard(table(spark, d, "documents"), shards.SHARDS))


@query("op13_fill_in_middle", middle.SQL)
def infilled(spark: SparkSession, d: str) -> DataFrame:
    return middle.digest(middle.fill_in_middle(table(spark, d, "documents")))
