"""Pairing the two sides of an exchange, and the parts of one request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each assistant turn with the turn before it, where there is one.

    The previous turn is found by an equi-join on (conversation, place), so one huge
    conversation is spread over all tasks by its turn numbers. Turn numbers must be consecutive;
    see ``pair_turns_with_gaps`` otherwise.
    """
    prompts = df.select(
        F.col(conv), (F.col(turn) + 1).alias(turn), F.col(text).alias("prompt"),
        F.col(role).alias("prompt_role"),
    )
    responses = df.filter(F.col(role) == "assistant").select(conv, turn, F.col(text).alias("response"))
    return responses.join(prompts, [conv, turn], "inner")


def pair_turns_with_gaps(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """As ``pair_turns`` for turn numbers with gaps: numbers are compacted first.

    Compacting takes a window per conversation over the turn numbers alone; the texts then join
    on (conversation, place).
    """
    from pyspark.sql import Window

    places = df.select(conv, turn).withColumn(
        "__place", F.row_number().over(Window.partitionBy(conv).orderBy(turn))
    )
    placed = df.join(places, [conv, turn])
    prompts = placed.select(
        F.col(conv), (F.col("__place") + 1).alias("__place"), F.col(text).alias("prompt"),
        F.col(role).alias("prompt_role"),
    )
    responses = placed.filter(F.col(role) == "assistant").select(
        conv, turn, "__place", F.col(text).alias("response")
    )
    return responses.join(prompts, [conv, "__place"], "inner").drop("__place")
