"""Preference conversations to single-turn (prompt, chosen, rejected) rows.

Works on rows of ``operators.nest.nest_preferences`` or ``preference_rows``. Everything
here is row-local apart from ``drop_bad_batches``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnloom.functions.templates import Template, recover_prompt
from turnloom.functions.text import strip
from turnloom.operators.nest import SALTS, SIDES, Nested
from turnloom.operators.rank import range_rank
from turnloom.operators.select import drop_empty
from turnloom.schemas import message


def validity(n_chosen: Column, n_rejected: Column) -> Column:
    """``ok``, ``empty`` (one side has no turns) or ``length_mismatch``."""
    return (
        F.when((n_chosen == 0) | (n_rejected == 0), "empty")
        .when(n_chosen != n_rejected, "length_mismatch")
        .otherwise("ok")
    )


def with_status(nested: Nested) -> DataFrame:
    return nested.rows.withColumn("status", validity(F.col("n_chosen"), F.col("n_rejected")))


def pair_validity(nested: Nested) -> DataFrame:
    """``conv_id, status`` of nested rows."""
    return with_status(nested).filter(F.col("first_pos") == 0).select("conv_id", "status")


def turn_validity(turns: DataFrame) -> DataFrame:
    """``conv_id, status`` straight from long turns: reads two columns, moves counts."""
    sizes = turns.groupBy("conv_id").agg(
        *[F.count_if(F.col("side") == s).alias(f"n_{s}") for s in SIDES]
    )
    return sizes.select(
        "conv_id", validity(F.col("n_chosen"), F.col("n_rejected")).alias("status")
    )


def role_aligned(nested: Nested) -> DataFrame:
    """``conv_id, aligned``: valid, with the same roles turn by turn (null equals null)."""
    same = F.forall(
        F.zip_with("chosen", "rejected", lambda c, r: c["role"].eqNullSafe(r["role"])), lambda x: x
    )
    rows = with_status(nested).select("conv_id", ((F.col("status") == "ok") & same).alias("aligned"))
    return rows.groupBy("conv_id").agg(F.bool_and("aligned").alias("aligned"))


def _exchange_starts(offset: int | Column) -> Column:
    """List positions offset, offset+2, ... whose message has a successor."""
    last = F.size("chosen") - 2
    start = F.lit(offset) if isinstance(offset, int) else offset
    return F.when(last >= start, F.sequence(start, last, F.lit(2))).otherwise(
        F.array().cast("array<int>")
    )


def _is_exchange(messages: str, i: Column) -> Column:
    return (F.get(messages, i)["role"] == "user") & (F.get(messages, i + 1)["role"] == "assistant")


def candidates_column(skip_leading_system: bool = False) -> Column:
    """User/assistant exchanges at even positions on both sides, as an array of structs.

    A leading system message shifts every exchange to odd positions, so such
    conversations give nothing unless ``skip_leading_system`` is set.
    """
    offset: int | Column = 0
    if skip_leading_system:
        leads = (F.get("chosen", F.lit(0))["role"] == "system") & (
            F.get("rejected", F.lit(0))["role"] == "system"
        )
        offset = F.when((F.col("first_pos") == 0) & leads, 1).otherwise(0)
    starts = F.filter(
        _exchange_starts(offset),
        lambda i: _is_exchange("chosen", i) & _is_exchange("rejected", i),
    )
    return F.transform(
        starts,
        lambda i: F.struct(
            (F.col("first_pos") + i).alias("pair_idx"),
            F.get("chosen", i)["content"].alias("chosen_prompt"),
            F.get("rejected", i)["content"].alias("rejected_prompt"),
            F.get("chosen", i + 1)["content"].alias("chosen"),
            F.get("rejected", i + 1)["content"].alias("rejected"),
        ),
    )


def pair_candidates(nested: Nested, skip_leading_system: bool = False) -> DataFrame:
    """One row per exchange of each valid conversation, texts as they are.

    ``pair_idx`` is the position of the user message in the conversation.
    """
    if nested.parts is not None and skip_leading_system != nested.skips_system:
        raise ValueError("long conversations were cut for another skip_leading_system")
    return (
        with_status(nested)
        .filter(F.col("status") == "ok")
        .select("conv_id", F.inline(candidates_column(skip_leading_system)))
    )


def survives(pair: Column) -> Column:
    """Same prompt on both sides, nothing blank, different answers; all after strip."""
    prompt, chosen, rejected = (strip(pair[c]) for c in ("chosen_prompt", *SIDES))
    return (
        (prompt == strip(pair["rejected_prompt"]))
        & (prompt != "")
        & (chosen != "")
        & (rejected != "")
        & (chosen != rejected)
    )


def single_turn_pairs(nested: Nested, skip_leading_system: bool = False) -> DataFrame:
    """``conv_id, pair_idx, prompt, chosen, rejected``: the surviving exchanges.

    A pair with a missing text is dropped.
    """
    kept = pair_candidates(nested, skip_leading_system).filter(
        survives(F.struct("chosen_prompt", "rejected_prompt", *SIDES))
    )
    return drop_empty(
        kept.select(
            "conv_id",
            "pair_idx",
            strip(F.col("chosen_prompt")).alias("prompt"),
            *[strip(F.col(s)).alias(s) for s in SIDES],
        ),
        "chosen",
    )


def drop_bad_batches(pairs: DataFrame, statuses: DataFrame, batch_size: int = 1000) -> DataFrame:
    """Drop the pairs of every batch that holds an invalid conversation.

    Batches are runs of ``batch_size`` conversations in ``conv_id`` order. ``statuses`` is
    ``(conv_id, status)`` of all conversations; only keys and flags are ranked.
    """
    flags = statuses.select("conv_id", (F.col("status") != "ok").alias("_bad"))
    batched = range_rank(flags, ["conv_id"]).withColumn(
        "_batch", F.expr(f"rank div {int(batch_size)}")
    )
    bad = (
        batched.withColumn("_bad", F.bool_or("_bad").over(W.partitionBy("_batch")))
        .filter(F.col("_bad"))
        .select("conv_id", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])).alias("_salt"))
    )
    # The pairs of one conversation are spread over the salts.
    salted = pairs.withColumn("_salt", F.pmod(F.hash("pair_idx"), F.lit(SALTS)))
    return salted.join(bad, ["conv_id", "_salt"], "left_anti").drop("_salt")


def rendered_prompts(pairs: DataFrame, template: Template) -> DataFrame:
    """Add ``rendered``, the prompt as a generation prompt, and ``recovered`` from it."""
    alone = F.array(message(F.lit("user"), "prompt"))
    return pairs.withColumn("rendered", template.text(alone, generation=True)).withColumn(
        "recovered", recover_prompt(F.col("rendered"))
    )


def chat_format(pairs: DataFrame) -> DataFrame:
    """The three texts as one-message lists."""
    return pairs.select(
        "conv_id",
        "pair_idx",
        F.array(message(F.lit("user"), "prompt")).alias("prompt"),
        *[F.array(message(F.lit("assistant"), s)).alias(s) for s in SIDES],
    )


def plain_pairs(chat: DataFrame) -> DataFrame:
    """Back from one-message lists to texts."""
    return chat.select(
        "conv_id",
        "pair_idx",
        *[F.get(c, F.lit(0))["content"].alias(c) for c in ("prompt", *SIDES)],
    )


def render_pairs(chat: DataFrame, templates: list[Template]) -> DataFrame:
    """Each pair under each template: the prompt ready for generation, and the whole
    text of prompt plus either answer. One pass; rows multiply by the template count."""
    rows = [
        F.struct(
            F.lit(t.name).alias("template"),
            t.text(F.col("prompt"), generation=True).alias("prompt"),
            *[t.text(F.concat("prompt", s)).alias(s) for s in SIDES],
        )
        for t in templates
    ]
    return chat.select("conv_id", "pair_idx", F.inline(F.array(*rows)))
