"""Chunks of the ID stream, sliding examples and mini-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators.blocks import cut
from tokenloom.operators.order import exclusive_sum


def chunk_assign(ids: DataFrame, context: int, chunk: int) -> DataFrame:
    """One row per (position, chunk).

    A chunk holds ``chunk`` tokens and starts with the last ``context`` tokens of the one
    before, so its place follows from arithmetic and needs no interval join.
    """
    if chunk <= context:
        raise ValueError("chunk must be larger than context")
    step = F.lit(chunk - context)
    low = F.greatest(F.lit(1), F.floor((F.col("gpos") - chunk) / step) + 2)
    high = F.floor(F.col("gpos") / step) + 1
    return ids.withColumn("chunk_id", F.explode(F.sequence(low, high)))


def chunks(ids: DataFrame, context: int, chunk: int) -> DataFrame:
    """``(chunk_id, start, ids)``; a group never exceeds ``chunk`` rows.

    A last chunk with nothing after its context holds no example and is left out. A position in its chunk and the id there
    travel as one number, its low bits the id plus 1, or 0 for none; the job fails on an id that these don't hold.
    """
    placed = chunk_assign(ids.select("gpos", "id"), context, chunk)
    bits = 63 - chunk.bit_length()
    wide = F.raise_error(F.concat(F.lit(f"id outside of 0 to 2^{bits} - 2: "), F.col("id").cast("string"))).cast("bigint")
    number = F.when((F.col("id") < 0) | (F.col("id") >= 2**bits - 1), wide).otherwise(F.coalesce(F.col("id") + 1, F.lit(0)))
    inside = F.col("gpos") - (F.col("chunk_id") - 1) * (chunk - context)
    packed = F.shiftleft(inside, bits).bitwiseOR(number)
    grouped = placed.groupBy("chunk_id").agg(
        F.min("gpos").alias("start"), F.sort_array(F.collect_list(packed)).alias("ids")
    )
    low = F.lit(2**bits - 1)
    unpacked = F.transform("ids", lambda v: F.nullif(v.bitwiseAND(low), F.lit(0).cast("bigint")) - 1)
    return grouped.filter(F.size("ids") > context).withColumn("ids", unpacked)


def chunks_of(texts: DataFrame, context: int, chunk: int) -> DataFrame:
    """:func:`chunks` of texts ``(gpos, ids)`` whose ids stand one after the other from ``gpos``: a row per text and chunk is shuffled, none per token."""
    if chunk <= context:
        raise ValueError("chunk must be larger than context")
    parts = cut(texts, "chunk_id", chunk - context, chunk)
    inside = F.sort_array(F.collect_list(F.struct("start", "part")))["part"]
    made = parts.groupBy("chunk_id").agg(F.min("start").alias("start"), F.flatten(inside).alias("ids"))
    return made.filter(F.size("ids") > context)


def examples(chunked: DataFrame, context: int, keep: int | None = None) -> DataFrame:
    """``(chunk_id, target_pos, context, target)``, made from chunk arrays without a shuffle.

    ``keep`` shortens the context to its last IDs. Each example cuts its context out of the array of its chunk.
    """
    width = context if keep is None else keep
    exploded = chunked.select("chunk_id", "start", "ids", F.posexplode("ids").alias("at", "target"))
    return exploded.filter(F.col("at") >= context).select(
        "chunk_id",
        (F.col("start") + F.col("at")).alias("target_pos"),
        F.slice("ids", F.col("at") - (width - 1), F.lit(width)).alias("context"),
        "target",
    )


def shuffled_examples(chunked: DataFrame, context: int, size: int, seed: int, keep: int | None = None) -> DataFrame:
    """:func:`examples` with the ``batch_id`` that :func:`shuffle_batches` gives them, and ``batch_size``, how many examples it has.

    A chunk is one row, so its examples are put in their random order inside of it, and none is shuffled.
    """
    width = context if keep is None else keep
    at = F.when(F.size("ids") > context, F.sequence(F.lit(context), F.size("ids") - 1))
    drawn = chunked.select("chunk_id", "start", "ids", F.posexplode(_drawn(at, seed)).alias("_rank", "at"))
    batch = F.floor(F.col("_rank") / size)
    left = F.size("ids") - context - batch * size
    return drawn.select(
        "chunk_id",
        batch.alias("batch_id"),
        F.least(left, F.lit(size)).cast("int").alias("batch_size"),
        (F.col("start") + F.col("at")).alias("target_pos"),
        F.slice("ids", F.col("at") - (width - 1), F.lit(width)).alias("context"),
        F.get("ids", F.col("at")).alias("target"),
    )


def batch_sizes(chunked: DataFrame, context: int, size: int, seed: int, keep: int | None = None) -> DataFrame:
    """:func:`examples` with the ``batch_size`` that :func:`shuffled_examples` gives them.

    All batches of a chunk are full but the last one, so only a chunk that has a short one puts its examples in order, to find
    those in it.
    """
    made = F.size("ids") - context
    short = made % size
    order = _drawn(F.sequence(F.lit(context), F.size("ids") - 1), seed)
    late = F.when((made > 0) & (short > 0), F.slice(order, made - short + 1, short)).otherwise(F.array().cast("array<int>"))
    width = context if keep is None else keep
    # Beside the generator it would be worked out for each example; below it, once for a chunk.
    told = chunked.withColumn("_late", late)
    sized = told.select("chunk_id", "start", "ids", "_late", F.posexplode("ids").alias("at", "target"))
    inside = (F.size("_late") > 0) & F.array_contains("_late", F.col("at"))
    return sized.filter(F.col("at") >= context).select(
        "chunk_id",
        F.when(inside, F.size("_late")).otherwise(F.lit(size)).alias("batch_size"),
        (F.col("start") + F.col("at")).alias("target_pos"),
        F.slice("ids", F.col("at") - (width - 1), F.lit(width)).alias("context"),
        "target",
    )


def _drawn(at: Column, seed: int) -> Column:
    """Indices of a chunk in its seeded random order."""
    lots = F.transform(at, lambda i: F.named_struct(F.lit("lot"), _lot(F.col("start") + i, seed), F.lit("at"), i))
    return F.sort_array(lots)["at"]


def _lot(position: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", position.cast("string"), F.lit(str(seed))))


def shuffle_batches(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """Add ``batch_id``: a seeded random order inside each chunk, cut into groups of ``size``."""
    inside = Window.partitionBy("chunk_id").orderBy(_lot(F.col("target_pos"), seed), "target_pos")
    number = F.row_number().over(inside)
    return rows.withColumn("batch_id", F.floor((number - 1) / size))


def chunk_stats(ids: DataFrame, context: int, chunk: int, batch: int) -> DataFrame:
    """Examples, batches and tokens read at the end of each chunk, from the ``gpos`` of tokens. Counts only, no arrays."""
    return span_stats(ids.select(F.col("gpos").alias("start"), F.lit(1).cast("bigint").alias("n")), context, chunk, batch)


def span_stats(spans: DataFrame, context: int, chunk: int, batch: int) -> DataFrame:
    """:func:`chunk_stats` from ``(start, n)`` of each text: a row per text and chunk, none per token."""
    if chunk <= context:
        raise ValueError("chunk must be larger than context")
    step = chunk - context
    end = F.col("start") + F.col("n")
    low = F.greatest(F.lit(1), F.floor((F.col("start") - chunk) / step) + 2)
    met = spans.filter("n > 0").withColumn("chunk_id", F.explode(F.sequence(low, F.floor((end - 1) / step) + 1)))
    first = (F.col("chunk_id") - 1) * step
    stop = F.least(end, first + chunk)
    sizes = (
        met.groupBy("chunk_id")
        .agg(F.sum(stop - F.greatest(F.col("start"), first)).alias("n"), F.max(stop).alias("seen_tokens"))
        .filter(F.col("n") > context)
    )
    made = F.col("n") - context
    return sizes.select(
        "chunk_id",
        made.alias("examples"),
        F.ceil(made / batch).alias("batches"),
        "seen_tokens",
    )


def token_budget(ids: DataFrame, limit: int) -> DataFrame:
    """Exactly the first ``limit`` tokens of the stream."""
    return ids.filter(F.col("gpos") < limit)


def progress(ids: DataFrame, first_uses: DataFrame, every: int) -> DataFrame:
    """``(block, tokens, new_tokens, new_rate)``, and ``bytes`` before the rate: running totals after each ``every`` tokens, and the
    share of new ones in the block itself.

    ``ids`` has ``gpos`` and, if known, ``bytes``, what each token takes of its text; ``first_uses`` has the stream position ``gpos`` of every new token.
    """
    block = F.floor(F.col("gpos") / every).alias("block")
    sums = {"tokens": F.count("*"), "bytes": F.sum("bytes")}
    read = ids.groupBy(block).agg(*[s.alias(n) for n, s in sums.items() if n == "tokens" or n in ids.columns])
    return progress_of(read, first_uses, every)


def progress_of(read: DataFrame, first_uses: DataFrame, every: int) -> DataFrame:
    """:func:`progress` of what each block has: ``read`` is ``(block, tokens)``, and ``bytes`` if known."""
    sums = [n for n in ("tokens", "bytes") if n in read.columns]
    new = first_uses.groupBy(F.floor(F.col("gpos") / every).alias("block")).agg(F.count("*").alias("_new"))
    rows = read.select("block", *[F.col(n).alias(f"_{n}") for n in sums]).join(new, "block", "left").fillna(0, ["_new"])
    names = ["tokens", "new", *[n for n in sums if n != "tokens"]]
    for name in names:
        rows = exclusive_sum(rows, "block", f"_{name}", f"_{name}_before", key_bits=32)
    total = {n: (F.col(f"_{n}_before") + F.col(f"_{n}")).alias("new_tokens" if n == "new" else n) for n in names}
    return rows.select(
        "block",
        *total.values(),
        (F.col("_new") / F.col("_tokens")).alias("new_rate"),
    )
