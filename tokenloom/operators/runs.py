"""Run metadata and series reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

META_FIELDS = ("vocab_size", "emb_dim", "hidden_dim", "context_size", "epoch", "chunk_index", "seen_tokens")


def run_metadata(stats: DataFrame, vocab: DataFrame, context: int, emb: int, hidden: int, epoch: int) -> DataFrame:
    """One row per chunk: the sizes and how far the run got."""
    size = vocab.agg(F.count("*")).scalar()
    return stats.select(
        size.alias("vocab_size"),
        F.lit(emb).cast("bigint").alias("emb_dim"),
        F.lit(hidden).cast("bigint").alias("hidden_dim"),
        F.lit(context).cast("bigint").alias("context_size"),
        F.lit(epoch).cast("bigint").alias("epoch"),
        F.col("chunk_id").alias("chunk_index"),
        "seen_tokens",
    )


def key_values(meta: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """One metadata row as ``(k, v)`` rows."""
    pairs = F.array(*[F.struct(F.lit(f).alias("k"), F.col(f).cast("bigint").alias("v")) for f in fields])
    return meta.select(F.inline(pairs))


def check_metadata(saved: DataFrame, current: DataFrame) -> DataFrame:
    """One row ``(n, report)``: every current key whose saved value differs or is missing, in key order."""
    both = current.withColumnRenamed("v", "b").join(saved.withColumnRenamed("v", "a"), "k", "left")
    differ = both.filter(~F.col("a").eqNullSafe(F.col("b"))).withColumn(
        "line", F.concat(
            "k", F.lit(": ckpt="), F.coalesce(F.col("a").cast("string"), F.lit("None")),
            F.lit(" vs actuel="), F.coalesce(F.col("b").cast("string"), F.lit("None")),
        )
    )
    lines = F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda s: s["line"])
    return differ.agg(F.count("*").alias("n"), F.array_join(lines, " | ").alias("report"))


def series_mean(rows: DataFrame, series: str, value: str) -> DataFrame:
    """Mean per series, and the mean of its row numbers 0 .. n-1."""
    return rows.groupBy(series).agg(
        F.count("*").alias("n"),
        F.avg(value).alias("mean"),
        ((F.count("*") - 1) / 2).alias("index_mean"),
    )
