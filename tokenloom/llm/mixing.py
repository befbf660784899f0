"""Mixing sources to target weights by hash-random keys, prefix sums and exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import SPACE_CLASS, WORD, stored

MAX_EPOCHS = 3  # Fixed value: how often a source may be repeated.
WEIGHTS = 3  # Fixed value: the sources weigh 1, 2, 3, 1, 2, 3, ...
BUCKET_ROWS = 4096  # mean rows of one bucket of keys
KEY_BITS = 60


def word_count(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(column: str, seed: int) -> Column:
    """A pseudo-random bigint of 60 bits, the same on every run and engine."""
    text = F.concat_ws(":", F.lit(str(seed)), F.col(column).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, source_rows, target)`` of rows ``(source, size)``.

    A target is a share by weight of all sizes, at most ``MAX_EPOCHS`` times its source; what
    the full sources leave is shared by weight among the rest. In the order of cap over weight
    the full sources come first, so one running sum finds them. One row per source.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = totals.withColumn("_w", (F.row_number().over(by_name) - 1) % WEIGHTS + 1).withColumn(
        "_cap", F.col("source_size") * MAX_EPOCHS
    )
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    shared = named.select(
        "*",
        (
            F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
        ).alias("_left"),
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))).alias("_rest"),
    ).withColumn("_full", _wide("_w") * _wide("_left") > _wide("_cap") * _wide("_rest"))
    # The first source that is not full fixes what a unit of weight gets.
    first = shared.withColumn("_free", ~F.col("_full")).select(
        "*",
        F.first(F.when(F.col("_free"), F.col("_left")), True).over(everything).alias("_unit"),
        F.first(F.when(F.col("_free"), F.col("_rest")), True).over(everything).alias("_weight"),
    )
    share = (F.col("_w") * F.col("_unit")).cast("double") / F.col("_weight")
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(share)
    return first.select("source", "source_size", "source_rows", target.alias("target"))


def prefix_sums(rows: DataFrame, group: str, key: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the group's rows that come before by ``key``.

    ``rows`` carries ``source_rows``, the rows of its group. Keys are uniform 60-bit numbers, so
    cutting their range into ``rows / BUCKET_ROWS`` parts gives buckets of a bounded size
    however large a group is. Each bucket is summed on its own and starts at the sum of the
    buckets before it, of which there are few. Equal keys keep the order of ``doc_id, size``.
    """
    width = F.floor(F.shiftleft(F.lit(1).cast("bigint"), KEY_BITS) / F.ceil(F.col("source_rows") / BUCKET_ROWS)) + 1
    cut = rows.withColumn("_bucket", F.floor(F.col(key) / width).cast("bigint"))
    sums = cut.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum"))
    # A level in between keeps the last window short: 4096 buckets a group of buckets.
    sums = sums.withColumn("_high", F.shiftright("_bucket", 12))
    low = Window.partitionBy(group, "_high").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    high = Window.partitionBy(group).orderBy("_high").rowsBetween(Window.unboundedPreceding, -1)
    highs = sums.groupBy(group, "_high").agg(F.sum("_sum").alias("_sum_high"))
    highs = highs.select(group, "_high", F.coalesce(F.sum("_sum_high").over(high), F.lit(0)).alias("_before_high"))
    starts = (
        sums.withColumn("_before_low", F.coalesce(F.sum("_sum").over(low), F.lit(0)))
        .alias("s")
        .join(highs.alias("h"), F.expr(f"s.{group} <=> h.{group} AND s._high = h._high"))
        .select(f"s.{group}", "_bucket", (F.col("_before_low") + F.col("_before_high")).alias("_start"))
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(key, "doc_id", value)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        local.alias("l")
        .join(starts.alias("s"), F.expr(f"l.{group} <=> s.{group} AND l._bucket = s._bucket"))
        .select("l.*", (F.col("_local") + F.col("_start")).alias(out))
        .drop("_bucket", "_local")
    )


def mix(docs: DataFrame, seed: int = 42) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``: how many words the mix takes of each document.

    Documents of a source come in the order of a hash of ``doc_id``. A source gives as many whole
    passes as its target holds, and one more pass up to the exact word at which its budget, the
    target without its fraction, is used up: the document at the cut gives its first words only.
    A null text has size 0 and gives nothing; null sources are one source, the last; repeated rows
    count each; other columns are ignored; no documents give no rows.
    """
    sizes = stored(
        docs.select("doc_id", "source", word_count("text").alias("size"), random_key("doc_id", seed).alias("_key")),
        "mix-sizes",
    )
    targets = source_targets(sizes)
    rows = sizes.alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source"))
    rows = rows.select("d.doc_id", "d.source", "d.size", "d._key", "t.source_size", "t.source_rows", "t.target")
    budget = F.floor("target").cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = budget - passes * F.col("source_size")
    summed = prefix_sums(rows, "source", "_key", "size", "_before")
    part = F.greatest(F.least(F.col("size"), rest - F.col("_before")), F.lit(0).cast("bigint"))
    taken = (passes * F.col("size") + part).alias("taken")
    return summed.select("doc_id", "source", "size", "source_size", "target", taken)


def first_words(text: Column, count: Column) -> Column:
    """The first ``count`` words of ``text`` with the white space before each."""
    pieces = F.regexp_extract_all(text, F.lit(f"[{SPACE_CLASS}]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), count), "")


def mixed_documents(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The mix itself: a document's row once per whole pass, then its first words for the last part.

    Columns are those of ``docs``; ``n_chars`` of a shortened text is counted anew. Documents
    without words are in no mix.
    """
    taken = mix(docs, seed).groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("same"))
    named = docs.withColumn("__mix_size", word_count("text"))
    # Rows with the same id, source and size split what they got evenly, the first rows more.
    joined = named.alias("d").join(
        taken.filter("taken > 0").alias("t"),
        F.expr("d.doc_id <=> t.doc_id AND d.source <=> t.source AND d.__mix_size = t.size"),
    )
    share = F.floor(F.col("t.taken") / F.col("t.same")).cast("bigint")
    whole, part = F.floor(share / F.col("d.__mix_size")).cast("int"), (share % F.col("d.__mix_size")).cast("int")
    copies = F.concat(
        F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>"))
    )
    rows = joined.select("d.*", F.explode(copies).alias("__mix_part"))
    text = F.when(F.col("__mix_part") > 0, first_words(F.col("text"), F.col("__mix_part"))).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col("__mix_part") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", counted)
    return rows.select(*docs.columns)


# The same in SQL. DuckDB writes a share's quotient of doubles like Spark.
SQL = r"""WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT AS key FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM t),
r AS (
  SELECT *, (SELECT sum(source_size) FROM w)::BIGINT - coalesce(sum(cap) OVER o, 0)::BIGINT AS unit,
    (SELECT sum(w) FROM w)::BIGINT - coalesce(sum(w) OVER o, 0)::BIGINT AS rest FROM w
  WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, w * unit > cap * rest AS is_full FROM r),
n AS (SELECT max(unit) AS unit, max(rest) AS rest FROM f WHERE NOT is_full),
g AS (
  SELECT f.source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE (f.w * n.unit)::DOUBLE / n.rest END AS target FROM f, n),
b AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN floor(g.target)::BIGINT // g.source_size ELSE 0 END AS passes,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  passes * size + greatest(least(size, floor(target)::BIGINT - passes * source_size - before), 0) AS taken FROM b"""
