"""Prompts for generation, and clean-up of logged responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from turnloom.functions.templates import BOS, EOS, IM_END, IM_START, Template, instruct_prompt
from turnloom.functions.text import strip
from turnloom.schemas import message


def instruct_prompts(turns: DataFrame) -> DataFrame:
    """``conv_id, text``: prompt of the first system and first user message.

    Null text without a user message. The two messages are picked by a map-side
    aggregation, so conversations are never gathered.
    """
    picked = turns.groupBy("conv_id").agg(*[_first_of(r).alias(r) for r in ("system", "user")])
    text = instruct_prompt(F.col("system.content"), F.col("user.content"))
    return picked.select("conv_id", text.alias("text"))


def _first_of(role: str) -> Column:
    place = F.struct("turn", F.struct("content").alias("rest"))
    first = F.min(F.when(F.col("role") == role, place))
    return first["rest"]


def prompt_grid(
    questions: DataFrame,
    question_id: str,
    question: str,
    systems: Sequence[tuple[int, str]],
    template: Template,
) -> DataFrame:
    """``question_id, system_id, prompt``: every question under every system prompt.

    The system prompts are a literal list, unfolded next to each question: no join.
    """
    listed = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("system_id"), F.lit(s).alias("system"))
            for i, s in systems
        ]
    )
    grid = questions.select(F.col(question_id).alias("question_id"), question, F.inline(listed))
    messages = F.array(message(F.lit("system"), "system"), message(F.lit("user"), question))
    return grid.select(
        "question_id", "system_id", template.text(messages, generation=True).alias("prompt")
    )


def clean_response(
    output: Column,
    prompt: Column,
    skip_special: bool = True,
    special_tokens: Sequence[str] = (IM_START, IM_END, BOS, EOS),
) -> Column:
    """Cut the prompt off the front, optionally drop special tokens, strip."""
    answer = F.substring(output, F.length(prompt) + 1, F.length(output))
    if skip_special:
        for token in special_tokens:
            answer = F.replace(answer, F.lit(token), F.lit(""))
    return strip(answer)
