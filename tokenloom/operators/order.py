"""Global order without a global sort task.

``Window.orderBy`` alone sends every row to one task. Here the bigint key is cut into
buckets of ``2**bits`` keys; each bucket is summed on its own, and the bucket totals go
through the same step again, until few are left. Keys are unique, so no bucket holds more than ``2**bits`` rows
however the data is skewed, and the cut depends on values only, so a retried task gives the
same answer.

A level only looks at the next ``bits`` bits of its keys, so it doesn't matter whether keys are dense or hashes spread
over all 64 bits: with three levels of 16 bits above the rows, each step, the last one too, meets at most 65,536
rows in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 16
KEY_BITS = 64  # of any bigint


def levels_for(bits: int = BITS, key_bits: int = KEY_BITS) -> int:
    """How many levels leave at most ``2**bits`` totals of keys below ``2**key_bits``."""
    return max(1, -(-key_bits // bits) - 1)


def exclusive_sum(
    df: DataFrame, key: str, value: str, out: str = "before", bits: int = BITS, key_bits: int = KEY_BITS
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows with a smaller ``key``.

    ``key`` must be a bigint that no two rows share: the job fails, naming it, on one that repeats, and on a null, because
    such rows have no order. Keys known to be below ``2**key_bits`` and not negative need fewer levels.
    """
    return _sum_level(df, key, value, out, bits, 1, levels_for(bits, key_bits))


def _sum_level(
    df: DataFrame, key: str, value: str, out: str, bits: int, level: int, levels: int
) -> DataFrame:
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    if level > levels:
        everything = before.partitionBy(F.lit(0)).orderBy(key)
        return df.withColumn(out, F.coalesce(F.sum(value).over(everything), F.lit(0)))
    bucket, inside, offset = f"_bucket{level}", f"_inside{level}", f"_offset{level}"
    last, total = f"_last{level}", f"_total{level}"
    # The coalesce marks the bucket as never null, and max(key) orders the totals one level up;
    # both keep the two branches below alike, so Spark runs the one exchange once.
    number = F.shiftright(F.col(key), bits * level)
    if level == 1:
        number = F.when(F.col(key).isNull(), _fail(F.lit(f"order key {key} is null"))).otherwise(number)
    cut = df.withColumn(bucket, F.coalesce(number, F.lit(0).cast("bigint"))).repartition(bucket)
    totals = cut.groupBy(bucket).agg(F.max(key).alias(last), F.sum(value).alias(total))
    offsets = _sum_level(totals, last, total, offset, bits, level + 1, levels)
    ordered = Window.partitionBy(bucket).orderBy(key)
    local = F.coalesce(F.sum(value).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if level == 1:
        # Equal keys share a bucket and stand next to each other. A filter meets every row; a column that a later
        # join doesn't ask for would not be worked out.
        again = F.concat(F.lit(f"order key {key} repeats: "), F.col(key).cast("string"))
        numbered = cut.select("*", local.alias(inside), (F.lag(key).over(ordered) == F.col(key)).alias("_again"))
        numbered = numbered.filter(F.when(F.col("_again"), _fail(again).isNotNull()).otherwise(True)).drop("_again")
    else:
        numbered = cut.withColumn(inside, local)
    return (
        numbered.join(offsets.select(bucket, offset), bucket)
        .withColumn(out, F.col(inside) + F.col(offset))
        .drop(bucket, inside, offset)
    )


def _fail(message: Column) -> Column:
    return F.raise_error(message).cast("bigint")


def dense_index(
    df: DataFrame, key: str, out: str = "index", bits: int = BITS, key_bits: int = KEY_BITS
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of the unique bigint ``key``."""
    counted = exclusive_sum(df.withColumn("_one", F.lit(1).cast("bigint")), key, "_one", out, bits, key_bits)
    return counted.drop("_one")


def byte_budget(df: DataFrame, key: str, size: str, limit: int, bits: int = BITS) -> DataFrame:
    """Rows in key order until their sizes reach ``limit``; the row that crosses it stays.

    The kept rows are those up to one key, so one value, found from ``(key, size)``, is the
    filter of the scan, and no text is shuffled.
    """
    keys = exclusive_sum(df.select(key, size), key, size, "_before", bits)
    last = keys.filter(F.col("_before") < limit).agg(F.max(key).alias("last"))
    return df.filter(F.col(key) <= last.scalar())


def token_starts(docs: DataFrame, key: str, tokens: str, bits: int = BITS) -> DataFrame:
    """``(key, start, n)``: the stream position at which each document begins, and its tokens.

    Only two narrow columns are shuffled, never the texts.
    """
    sizes = docs.select(key, F.size(tokens).cast("bigint").alias("_n"))
    return exclusive_sum(sizes, key, "_n", "start", bits).select(key, "start", F.col("_n").alias("n"))
