"""Prompt/response pairs from a table of turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import clean_dialog, dialog_line, is_turn_pair

BLOCK = 4096


def dialog_turns(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, turn, prompt, response)``: a user turn and the assistant turn right after it.

    System turns do not count. The window runs over blocks of turns, so that one endless
    conversation does not end up in one task; the first turn of each later block is looked up
    for the last turn of the block before.
    """
    said = turns.filter("role IN ('user', 'assistant')").withColumn(
        "_block", F.floor(F.col("turn") / block)
    )
    inside = Window.partitionBy("conv_id", "_block").orderBy("turn")
    rows = said.withColumn("_next", F.lead(F.struct("role", "text")).over(inside))
    heads = (
        said.filter("_block > 0")
        .groupBy("conv_id", "_block")
        .agg(F.min_by(F.struct("role", "text"), "turn").alias("_head"))
    )
    # The last turn of a block goes on with the head of the conversation's next block.
    later = Window.partitionBy("conv_id").orderBy("_block")
    ahead = (
        said.select("conv_id", "_block")
        .distinct()
        .join(heads, ["conv_id", "_block"], "left")
        .withColumn("_head", F.lead("_head").over(later))
        .filter("_head IS NOT NULL")
    )
    pairs = rows.join(ahead, ["conv_id", "_block"], "left").withColumn(
        "_next", F.coalesce("_next", "_head")
    )
    return pairs.filter("role = 'user' AND _next.role = 'assistant'").select(
        "conv_id", "turn", F.col("text").alias("prompt"), F.col("_next.text").alias("response")
    )


def dialog_pairs(dialogs: DataFrame) -> DataFrame:
    """Clean both sides and keep pairs that are long enough on both."""
    cleaned = dialogs.withColumn("prompt", clean_dialog("prompt")).withColumn(
        "response", clean_dialog("response")
    )
    return cleaned.filter(is_turn_pair("prompt", "response"))


def dialog_lines(dialogs: DataFrame) -> DataFrame:
    return dialog_pairs(dialogs).withColumn("line", dialog_line("prompt", "response"))
