"""Conversations to train and eval text datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnloom.functions.templates import Template
from turnloom.operators.nest import MAX_TURNS, Nested, nest_turns
from turnloom.operators.render import render
from turnloom.operators.select import drop_null, take_penultimate
from turnloom.operators.splits import prefix_split
from turnloom.sources.writers import write_splits


def texts(turns: DataFrame, template: Template, max_turns: int = MAX_TURNS) -> DataFrame:
    """``conv_id, text`` of long turns, without null texts."""
    return drop_null(render(nest_turns(turns, max_turns=max_turns), template))


def preview(
    turns: DataFrame, template: Template, missing: Column | None = None
) -> DataFrame:
    """``conv_id, text`` of the last conversation but one of those that have a text.

    ``missing`` marks turns that leave a conversation without a text (for ChatML: a null
    role or content). Only flags are gathered to find the key, and only one text is made.
    """
    lost = F.col("role").isNull() | F.col("content").isNull() if missing is None else missing
    flags = turns.groupBy("conv_id").agg(F.bool_or(lost).alias("_lost"))
    printed = flags.filter(~F.col("_lost"))
    return texts(take_penultimate(turns, "conv_id", printed), template)


def split_texts(
    nested: Nested, template: Template, n_eval: int = 5000, mode: str = "overlap"
) -> DataFrame:
    """``conv_id, text, split``. The prefix is taken over all conversations, before
    null texts are dropped."""
    return drop_null(prefix_split(render(nested, template), "conv_id", n_eval, mode))


def prepare(
    nested: Nested, template: Template, root: str, n_eval: int = 5000, mode: str = "overlap"
) -> None:
    """Write the split texts below ``root``."""
    write_splits(split_texts(nested, template, n_eval, mode), root)
