"""Sinks. Spark's commit protocol gives what a temporary file and a rename give elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str, value: str | Column, *order: str) -> None:
    """Text lines in ``order``: part files sorted by name are the whole file in order."""
    line = F.col(value) if isinstance(value, str) else value
    rows = df.orderBy(*order) if order else df
    rows.select(line.alias("value")).write.text(path)


def write_words(df: DataFrame, path: str, value: str | Column, *order: str) -> None:
    """Words in ``order`` with a blank after each, without line ends: part files put together are one line.

    No line is ever put together, so it may be longer than any task could hold.
    """
    word = F.col(value) if isinstance(value, str) else value
    df.orderBy(*order).select(word.cast("string").alias("value")).write.option("lineSep", " ").text(path)


def write_vocab_json(vocab: DataFrame, path: str) -> None:
    """One JSON object, an entry per line, in id order over the part files.

    Each entry but the first begins with its comma, so no part needs to know the next one.
    """
    entry = F.to_json(F.create_map("token", "id"))
    first = vocab.agg(F.min("id")).scalar()
    comma = F.when(F.col("id") == first, "  ").otherwise(", ")
    body = F.concat(comma, F.substring(entry, F.lit(2), F.length(entry) - 2))
    rows = vocab.select("id", F.lit(1).alias("part"), body.alias("line"))
    ends = vocab.agg(F.min("id").alias("low"), F.max("id").alias("high")).select(
        F.inline(
            F.array(
                F.struct(F.col("low").alias("id"), F.lit(0).alias("part"), F.lit("{").alias("line")),
                F.struct(F.col("high").alias("id"), F.lit(2).alias("part"), F.lit("}").alias("line")),
            )
        )
    )
    write_lines(rows.unionByName(ends), path, "line", "id", "part")


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
