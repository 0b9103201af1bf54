"""Conversations to texts with a chat template."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from turnloom.functions.templates import Template
from turnloom.operators.nest import Nested

ROW = ("conv_id", "first_pos")


def render_parts(parts: DataFrame, template: Template) -> DataFrame:
    """``conv_id, first_pos, part``: the body text of each row of long conversations.

    Ordered by ``first_pos``, the parts make up the body; for a conversation too long
    for one cell this table is the result. What a row leaves for the next one is a short
    text, and only that is ordered by conversation.
    """
    carry = None
    if template.carry is not None:
        left = parts.select(*ROW, template.carry(F.col("messages")).alias("_left"))
        earlier = W.partitionBy("conv_id").orderBy("first_pos")
        so_far = earlier.rowsBetween(W.unboundedPreceding, -1)
        carried = left.select(*ROW, F.last("_left", ignorenulls=True).over(so_far).alias("_carry"))
        parts, carry = parts.join(carried, list(ROW)), F.col("_carry")
    return parts.select(*ROW, template.body(F.col("messages"), carry).alias("part"))


def _joined(parts: DataFrame, template: Template, generation: bool) -> DataFrame:
    listed = F.sort_array(F.collect_list(F.struct("first_pos", "part")))
    gathered = render_parts(parts, template).groupBy("conv_id").agg(
        listed.alias("_parts"), F.bool_or(F.col("part").isNull()).alias("_missing")
    )
    body = F.array_join(F.transform("_parts", lambda p: p["part"]), "")
    text = template.finish(F.when(~F.col("_missing"), body), generation)
    return gathered.select("conv_id", text.alias("text"))


def render(nested: Nested, template: Template, generation: bool = False) -> DataFrame:
    """``conv_id, text``, one row per conversation; null text where content is missing.

    A projection of the nested rows. Parts of long conversations, if there are any, are
    rendered one by one and then joined in order.
    """
    text = template.text(F.col("messages"), generation)
    whole = nested.whole.select("conv_id", text.alias("text"))
    if nested.parts is None:
        return whole
    return whole.unionByName(_joined(nested.parts, template, generation))
