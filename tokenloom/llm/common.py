"""Small helpers the operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import shared_dir

# The white space that ends a word, as a Java character class and as characters.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\f\r"
WORD = f"[^{SPACE_CLASS}]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    It cuts the lineage at a file all executors see, and later plans read only the columns
    they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row.

    Spark may copy a projected expression into a lambda, where it would run once per element;
    a lambda variable is a value.
    """
    return F.transform(F.array(value), body)[0]


def crc32_bucket(key: str, buckets: int) -> Column:
    """``crc32(key as text) mod buckets``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % buckets


def row_key(*columns: str) -> Column:
    """A 128-bit name of a row's values, null-safe; equal rows share it."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts += [F.when(text.isNull(), "n").otherwise(F.lit("v")), F.coalesce(F.length(text), F.lit(0)).cast("string")]
        parts += [F.coalesce(text, F.lit(""))]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts).cast("binary")))
