"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# No part of a frequent key holds more than one row in so many. So at most so many keys are frequent, and they
# have at most twice so many parts, however large the data is.
SHARE = 10_000


def frequent(counts: DataFrame, keys: list[str], weight: str, share: int = SHARE) -> DataFrame:
    """``_hash, _parts`` of the frequent keys of ``counts``, which holds each key once and how many rows have it.

    A key is frequent if more than one row in ``share`` has it, and has so many parts that each is below that. Keys stand as 64-bit
    hashes, so the table has at most ``share`` rows of 12 bytes whatever the keys are; a key that shares the hash of a
    frequent one is parted as well.
    """
    total = counts.agg(F.coalesce(F.sum(weight), F.lit(0))).scalar()
    parts = F.ceil(F.col(weight) * share / F.greatest(total, F.lit(1))).cast("int")
    hot = counts.filter(F.col(weight) * share > total).select(F.xxhash64(*keys).alias("_hash"), parts.alias("_parts"))
    return hot.groupBy("_hash").agg(F.max("_parts").alias("_parts"))


def _salt_source(rows: DataFrame, keys: list[str]) -> list[str]:
    """Columns whose values tell rows of one key apart."""
    kinds = (T.MapType, T.VariantType)
    return [f.name for f in rows.schema.fields if f.name not in keys and not isinstance(f.dataType, kinds)]


def spread_join(
    rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", hot: DataFrame | None = None
) -> DataFrame:
    """Join ``rows`` with a ``table`` of unique keys in one pass over either: ``inner``, ``left`` or ``left_anti``.

    ``hot`` names the frequent keys of ``rows`` and their parts (see :func:`frequent`). Their rows are dealt to
    the parts by a hash of their other values, which a retried task repeats, and meet a copy of the table's row in each. Without
    ``hot`` nobody has counted the keys yet: adaptive execution then counts while it shuffles and splits what is too large.
    """
    if hot is None:
        return rows.join(table, keys, how)
    marks = F.broadcast(hot)
    parts = F.coalesce("_parts", F.lit(1))
    others = _salt_source(rows, keys)
    salt = F.pmod(F.xxhash64(*others), parts).cast("int") if others else F.lit(0)
    dealt = rows.withColumn("_hash", F.xxhash64(*keys)).join(marks, "_hash", "left").withColumn("_salt", salt)
    copied = table.withColumn("_hash", F.xxhash64(*keys)).join(marks, "_hash", "left")
    copied = copied.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_hash", "_parts")
    return dealt.drop("_hash", "_parts").join(copied, [*keys, "_salt"], how).drop("_salt")


def hot_join(
    rows: DataFrame, table: DataFrame, keys: list[str], weight: str, how: str = "inner", share: int = SHARE
) -> DataFrame:
    """Join ``rows`` with a ``table`` of unique keys that knows how many rows have each (``weight``, dropped from the result).

    Materialize ``table`` first, as its weights are read before.
    """
    return spread_join(rows, table.drop(weight), keys, how, frequent(table, keys, weight, share))
