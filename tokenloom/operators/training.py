"""Word classes that learn on: self-training and corrections, each with a new fit.

A lexicon has ``(row_id, texte, classe, pos_tag)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators import classify
from tokenloom.operators.classify import TextClassifier
from tokenloom.operators.matching import THRESHOLD, append_rows, best_match
from tokenloom.session import materialize

LEXICON = ["row_id", "texte", "classe", "pos_tag"]


def fit_lexicon(lexicon: DataFrame) -> TextClassifier:
    return classify.fit(lexicon.select(F.col("texte").alias("text"), "classe"))


def numbered_after(rows: DataFrame, key: str, first: int, out: str = "row_id") -> DataFrame:
    """Number rows with distinct texts ``key`` from ``first`` on, in an order of their own: by two bytes of a hash, then by text.

    The 65,536 counts of equal bytes are summed up, and each such group is numbered on its own.
    """
    cut = rows.withColumn("_group", F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 4), 16, 10).cast("int"))
    counts = cut.groupBy("_group").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_group").orderBy(key)) - 1
    placed = cut.withColumn("_at", inside).join(F.broadcast(starts), "_group")
    number = (F.col("_start") + F.col("_at") + first).cast("bigint")
    return placed.withColumn(out, number).drop("_group", "_start", "_at")


def self_train(
    words: DataFrame, lexicon: DataFrame, threshold: int = THRESHOLD
) -> tuple[DataFrame, TextClassifier, int]:
    """Fit, add new words whose predicted class is the class of their best match, and start again until none is added.

    Returns the lexicon, with ``round`` (0 for the given rows), the model of all its rows, and the number of rounds that added words.
    Each round is stored. A round only matches the words still open with the entries that the round before added, and an
    older entry wins against an equally good new one, as its row number is lower. An added word has no tag.
    """
    rows = materialize(lexicon.select(*LEXICON, F.lit(0).alias("round")))
    known = rows.select(F.col("texte").alias("word")).distinct()
    open_ = words.select("word").distinct().join(known, "word", "left_anti")
    best = materialize(best_match(open_, rows.drop("round"), threshold).select("word", "row_id", "classe", "score"))
    model, rounds = fit_lexicon(rows), 0
    while True:
        said = model.predict(best.withColumn("text", F.col("word"))).filter(F.col("predicted") == F.col("classe"))
        first = (rows.agg(F.max("row_id")).first()[0] or 0) + 1
        tag = F.lit(None).cast(lexicon.schema["pos_tag"].dataType).alias("pos_tag")
        new = said.select(F.col("word").alias("texte"), "classe", tag, F.lit(rounds + 1).alias("round"))
        new = materialize(numbered_after(new, "texte", first).select(*LEXICON, "round"))
        if new.isEmpty():
            return rows, model, rounds
        rounds += 1
        rows = materialize(rows.unionByName(new))
        left = open_.join(new.select(F.col("texte").alias("word")), "word", "left_anti")
        open_ = materialize(left)
        fresh = best_match(open_, new.drop("round"), threshold).select("word", "row_id", "classe", "score")
        both = best.join(open_, "word", "left_semi").unionByName(fresh)
        choice = F.max_by(F.struct("row_id", "classe", "score"), F.struct("score", -F.col("row_id"))).alias("b")
        best = materialize(both.groupBy("word").agg(choice).select("word", "b.row_id", "b.classe", "b.score"))
        model = fit_lexicon(rows)


def apply_corrections(lexicon: DataFrame, corrections: DataFrame) -> tuple[DataFrame, TextClassifier]:
    """The lexicon with all ``corrections`` (``texte, classe``, and what else they know) added at once, and the model of it.

    Corrections only add rows: a corrected word then stands there with both classes.
    """
    rows = materialize(append_rows(lexicon, corrections))
    return rows, fit_lexicon(rows)
