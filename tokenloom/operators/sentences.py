"""Sentences from word lists, drawn by seeded hashes instead of a cross product.

To draw until a sentence is accepted gives every accepted sentence the same chance. So an accepted
sentence is drawn directly: first which slots take an accepted word, in proportion to the number of such
sentences, then a word for each slot. No draw is wasted, and no text is given up: without a
result no sentence of the lists can be accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import sentence, split_phrase
from tokenloom.operators.order import dense_index

ARTICLE = "article"


def seeded_number(*parts: Column | str) -> Column:
    """A bigint from the MD5 of the parts, the same on every run and engine."""
    text = F.concat_ws(":", *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def pick(rows: DataFrame, words: DataFrame, row: str, slot: str, seed: int) -> DataFrame:
    """Add column ``slot``: one random word of the list per row, repeats weighing in.

    ``words`` has ``(row_id, word)``. The draw is a list position, so the list is numbered and
    met by an equi-join; the product of the two tables is never built.
    """
    numbered = dense_index(words.select("row_id", "word"), "row_id", "_at")
    size = words.agg(F.count("*")).scalar()
    drawn = rows.withColumn("_at", F.pmod(seeded_number(row, F.lit(slot), F.lit(seed)), size))
    return drawn.join(numbered.select("_at", F.col("word").alias(slot)), "_at").drop("_at")


def draw_sentences(
    rows: DataFrame, lists: dict[str, DataFrame], row: str, seed: int
) -> DataFrame:
    """Add one word per slot and their ``phrase``, in the order of ``lists``."""
    out = rows
    for slot, words in lists.items():
        out = pick(out, words, row, slot, seed)
    return out.withColumn("phrase", sentence(*lists))


def category_hits(phrases: DataFrame, tags: DataFrame, row: str, starts: DataFrame) -> DataFrame:
    """``(row, hits, has_article)`` per phrase: words whose category is among the row's start set.

    ``tags`` is ``(word, category)`` with unique words, ``starts`` is ``(row, category)``.
    """
    words = phrases.select(row, F.explode(split_phrase("phrase")).alias("word"))
    tagged = words.join(tags.select("word", "category"), "word", "left")
    wanted = starts.select(row, "category").distinct().withColumn("_hit", F.lit(True))
    return (
        tagged.join(wanted, [row, "category"], "left")
        .groupBy(row)
        .agg(
            F.count_if(F.coalesce("_hit", F.lit(False))).alias("hits"),
            F.bool_or(F.coalesce(F.col("category") == "article", F.lit(False))).alias("has_article"),
        )
    )


def numbered_lists(lists: dict[str, DataFrame], tags: DataFrame) -> DataFrame:
    """``(slot, kind, at, word)``: each list in two parts, words with the slot's own category
    (kind 0) and articles (kind 1), numbered in row order.

    ``lists`` holds ``(row_id, word)`` per slot, ``tags`` one category per word.
    """
    parts = []
    for slot, words in lists.items():
        tagged = words.join(tags.select("word", "category"), "word")
        for kind, wanted in enumerate((F.col("category") != ARTICLE, F.col("category") == ARTICLE)):
            numbered = dense_index(tagged.filter(wanted).select("row_id", "word"), "row_id", "at")
            parts.append(numbered.select(F.lit(slot).alias("slot"), F.lit(kind).alias("kind"), "at", "word"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _wide(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _share(row: str, name: str, seed: int, total: Column) -> Column:
    """A seeded whole number from 0 to ``total - 1``."""
    drawn = _wide(seeded_number(row, F.lit(name), F.lit(seed))) * _wide(total)
    return F.floor(drawn / F.lit(1 << 32).cast("decimal(38,0)")).cast("decimal(38,0)")


def draw_accepted(
    rows: DataFrame, numbered: DataFrame, slots: list[str], row: str, name: str, least: int, seed: int
) -> DataFrame:
    """``(row, phrase)``: for every row one sentence with at least ``least`` accepted words.

    ``rows`` has per slot two flags, ``<slot>_0`` and ``<slot>_1``: whether words of that kind are
    accepted. ``numbered`` comes from ``numbered_lists``. Rows for which no sentence can be accepted are absent.
    """
    sizes = {(r["slot"], r["kind"]): r["n"] for r in numbered.groupBy("slot", "kind").agg(F.count("*").alias("n")).collect()}
    good, bad = {}, {}
    for slot in slots:
        n = [F.lit(sizes.get((slot, k), 0)).cast("bigint") for k in (0, 1)]
        good[slot] = F.when(F.col(f"{slot}_0"), n[0]).otherwise(0) + F.when(F.col(f"{slot}_1"), n[1]).otherwise(0)
        bad[slot] = n[0] + n[1] - good[slot]
    counted = rows.select(
        "*", *[good[s].alias(f"{s}_good") for s in slots], *[bad[s].alias(f"{s}_bad") for s in slots]
    )
    patterns = [p for p in range(1 << len(slots)) if p.bit_count() >= least]
    ways = []
    for p in patterns:
        product = _wide(F.lit(1))
        for i, s in enumerate(slots):
            product = _wide(product * _wide(F.col(f"{s}_good" if p >> i & 1 else f"{s}_bad")))
        ways.append(product)
    summed = counted.withColumn("_ways", F.array(*ways)).withColumn(
        "_total", F.aggregate("_ways", _wide(F.lit(0)), lambda a, x: _wide(a + x))
    )
    at = summed.filter(F.col("_total") > 0).withColumn("_at", _share(row, name, seed, F.col("_total")))
    # The first pattern up to which more ways lie than the drawn number.
    passed = F.aggregate(
        "_ways",
        F.struct(F.col("_at").alias("left"), F.lit(0).alias("n")),
        lambda a, x: F.struct(
            _wide(a["left"] - x).alias("left"), (a["n"] + F.when(a["left"] >= x, 1).otherwise(0)).alias("n")
        ),
        lambda a: a["n"],
    )
    # Past the right pattern ``left`` is negative, so no later one counts.
    out = at.withColumn("_pattern", F.element_at(F.array(*[F.lit(p) for p in patterns]), passed + 1))
    for i, slot in enumerate(slots):
        hit = F.col("_pattern").bitwiseAND(F.lit(1 << i)) != 0
        room = F.when(hit, F.col(f"{slot}_good")).otherwise(F.col(f"{slot}_bad"))
        place = _share(row, f"{name}-{slot}", seed, room).cast("bigint")
        # Kind 0 comes first among the words that are wanted here.
        first = F.when(F.col(f"{slot}_0") == hit, F.lit(sizes.get((slot, 0), 0)).cast("bigint")).otherwise(0)
        placed = out.withColumn("_place", place).withColumn("_first", first)
        kind = F.when(F.col("_place") >= F.col("_first"), 1).otherwise(0)
        placed = placed.withColumn("_kind", kind).withColumn(
            "_place", F.when(F.col("_kind") == 1, F.col("_place") - F.col("_first")).otherwise(F.col("_place"))
        )
        words = numbered.filter(F.col("slot") == slot).select(
            F.col("kind").alias("_kind"), F.col("at").alias("_place"), F.col("word").alias(f"{slot}_word")
        )
        out = placed.join(words, ["_kind", "_place"]).drop("_kind", "_place", "_first")
    return out.select(row, sentence(*[f"{s}_word" for s in slots]).alias("phrase"))
