"""Tokens and the token -> id table.

A token table has ``(doc_id, pos, token)``; a vocabulary has ``(token, id, n)``, where ``n``
is how often the token was seen when it was added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import compress_id, split_ws
from tokenloom.operators.order import dense_index, token_starts
from tokenloom.operators.skew import spread_join
from tokenloom.session import materialize


def tokenize(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per whitespace token."""
    tokens = docs.select(F.col(key).alias("doc_id"), F.posexplode(split_ws(text)).alias("pos", "token"))
    return tokens.withColumn("pos", F.col("pos").cast("bigint"))


def stream_starts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, start)`` of each text in the whole token stream."""
    return stream_spans(docs, key, text).select("doc_id", "start")


def stream_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, start, n)``: where each text begins in the whole token stream, and how many tokens it has."""
    return token_starts(docs.select(F.col(key).alias("doc_id"), split_ws(text).alias("_t")), "doc_id", "_t")


def positions(spans: DataFrame) -> DataFrame:
    """``(doc_id, gpos)``: a row per token, from the ``spans`` of the texts alone; no text is read or shuffled.

    Spans come out of few tasks, as they are small, and are dealt out before they grow.
    """
    parts = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.col("start") + F.col("n") - 1
    return spans.repartition(parts, "doc_id").filter("n > 0").select("doc_id", F.explode(F.sequence("start", last)).alias("gpos"))


def placed_tokens(docs: DataFrame, starts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, start, pos, gpos, token)`` of texts whose ``starts`` are known.

    The start of a text joins before the tokens are exploded: one row per text, not per token.
    """
    placed = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(starts, "doc_id")
    tokens = placed.select("doc_id", "start", F.posexplode(split_ws("text")).alias("pos", "token"))
    return tokens.select("doc_id", "start", "pos", (F.col("start") + F.col("pos")).alias("gpos"), "token")


def first_seen(tokens: DataFrame) -> DataFrame:
    """``(token, gpos, n)``: each token once, with its first place in the stream and its count, of tokens with a ``gpos``.

    Both are plain numbers, so tokens, hot ones too, are combined by hash before they are shuffled and never sorted.
    """
    return tokens.groupBy("token").agg(F.min("gpos").alias("gpos"), F.count("*").alias("n"))


def _by_first_use(seen: DataFrame) -> DataFrame:
    """Number the tokens of :func:`first_seen`, stored before, as the numbering reads them twice."""
    return dense_index(materialize(seen), "gpos", key_bits=48)


def build(
    docs: DataFrame, start: int = 0, key: str = "doc_id", text: str = "text", starts: DataFrame | None = None
) -> DataFrame:
    """Vocabulary of ``docs``; ids count up from ``start`` in order of first use.

    One pass groups the tokens, one counts tokens per text, unless the ``starts`` that it
    gives are known. The order key of a distinct token is its place in the whole stream, so one huge text cannot make
    one huge sort.
    """
    starts = stream_starts(docs, key, text) if starts is None else starts
    ranked = _by_first_use(first_seen(placed_tokens(docs, starts, key, text)))
    return ranked.select("token", (F.col("index") + F.lit(start).cast("bigint")).alias("id"), "n")


def next_id(vocab: DataFrame) -> DataFrame:
    """One row: the next free id, 0 for an empty vocabulary."""
    return vocab.agg((F.coalesce(F.max("id"), F.lit(-1).cast("bigint")) + 1).alias("next_id"))


def missing(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Distinct tokens outside the vocabulary, with first place ``(doc_id, pos)`` and count."""
    first = F.min(F.struct("doc_id", "pos")).alias("first")
    seen = tokens.groupBy("token").agg(first, F.count("*").alias("n"))
    return seen.join(vocab.select("token"), "token", "left_anti")


def additions(
    docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text",
    first: int | None = None, starts: DataFrame | None = None,
) -> DataFrame:
    """The rows to append to ``vocab`` so that it covers ``docs``; ids count from ``first``, if it is known."""
    starts = stream_starts(docs, key, text) if starts is None else starts
    seen = first_seen(placed_tokens(docs, starts, key, text))
    ranked = _by_first_use(seen.join(vocab.select("token"), "token", "left_anti"))
    begin = next_id(vocab).scalar() if first is None else F.lit(first).cast("bigint")
    return ranked.select("token", (F.col("index") + begin).alias("id"), "n")


def extend(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Known tokens keep their ids; new ones follow in order of first use."""
    return vocab.select("token", "id", "n").unionByName(additions(docs, vocab, key, text))


def used_entries(vocab: DataFrame, tokens: DataFrame) -> DataFrame:
    """Vocabulary rows whose token occurs."""
    return vocab.join(tokens.select("token").distinct(), "token", "left_semi")


def encode_known(tokens: DataFrame, vocab: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Replace tokens by ids and drop unknown ones; all other columns stay.

    The tokens are read once. ``hot`` names the frequent ones and their parts if somebody has counted them (see
    ``skew.frequent``).
    """
    return spread_join(tokens, vocab.select("token", "id"), ["token"], hot=hot).drop("token")


def unknown(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Token rows outside the vocabulary."""
    return spread_join(tokens, vocab.select("token"), ["token"], "left_anti")


def duplicates(entries: DataFrame) -> DataFrame:
    """Tokens or ids that occur more than once: ``(kind, value, n)``."""
    def repeated(name: str) -> DataFrame:
        groups = entries.groupBy(F.col(name).cast("string").alias("value")).agg(F.count("*").alias("n"))
        return groups.filter("n > 1").select(F.lit(name).alias("kind"), "value", "n")

    return repeated("token").unionByName(repeated("id"))


def checked(entries: DataFrame) -> DataFrame:
    """``entries`` themselves; the job fails, naming one, if a token or an id stands twice or is null.

    Equal tokens meet in one shuffle and equal ids in another; an entry is held against the one before it there.
    """
    for name in ("token", "id"):
        order = Window.partitionBy(name).orderBy(*[c for c in ("token", "id") if c in entries.columns])
        again = F.lag(F.lit(1)).over(order).isNotNull()
        value = F.coalesce(F.col(name).cast("string"), F.lit("null"))
        bad = F.raise_error(F.concat(F.lit(f"{name} of a vocabulary stands twice or is null: "), value))
        kind = entries.schema[name].dataType
        entries = entries.withColumn(name, F.when(again | F.col(name).isNull(), bad.cast(kind)).otherwise(F.col(name)))
    return entries


def numeric_ids(entries: DataFrame, on_bad_id: str = "skip") -> DataFrame:
    """Read ``id`` as a number; rows that are none are skipped or fail the job."""
    if on_bad_id == "fail":
        return entries.withColumn("id", F.col("id").cast("bigint"))
    return entries.withColumn("id", F.expr("try_cast(id AS bigint)")).filter("id IS NOT NULL")


def slots(entries: DataFrame, limit: int, order: str = "id") -> DataFrame:
    """``(slot, token)`` after folding ids into ``limit`` slots; the first entry keeps its slot."""
    return entries.groupBy(compress_id("id", limit).alias("slot")).agg(
        F.min_by("token", order).alias("token")
    )


def collisions(entries: DataFrame, limit: int) -> DataFrame:
    """One row: largest id, entries that lost their slot, and whether decoding is unsafe.

    Slots are counted by grouping first, so the distinct count has no single hot task.
    """
    per_slot = entries.groupBy(compress_id("id", limit).alias("slot")).agg(
        F.max("id").alias("top"), F.count("*").alias("n")
    )
    stats = per_slot.agg(
        F.coalesce(F.max("top"), F.lit(-1)).alias("max_raw_id"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("collisions"),
    )
    return stats.withColumn("unsafe", (F.col("max_raw_id") >= limit) | (F.col("collisions") > 0))
