"""Preference conversations to single-turn pairs, as a table or as JSONL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from turnloom.functions.templates import chatml_spaced
from turnloom.operators import pairs as P
from turnloom.operators.nest import MAX_TURNS, Nested, nest_preferences, preference_rows
from turnloom.operators.select import exclude_source, take_prefix
from turnloom.sources.writers import write_jsonl

# Fixed value: the source left out by default.
EXCLUDED_SOURCE = "toxic-dpo-v0.2"


def _selected(df: DataFrame, exclude: str | None, first: int | None) -> DataFrame:
    kept = df if exclude is None else exclude_source(df, exclude)
    return kept if first is None else take_prefix(kept, "conv_id", first)


def pairs_from_turns(
    turns: DataFrame,
    exclude: str | None = EXCLUDED_SOURCE,
    first: int | None = None,
    on_invalid: str = "drop_conversation",
    batch_size: int = 1000,
    max_turns: int | None = MAX_TURNS,
    probe: DataFrame | None = None,
    skip_leading_system: bool = False,
) -> DataFrame:
    """Pairs of long two-sided turns.

    Source filter and prefix act on the turns, before the one shuffle that gathers
    conversations. ``first`` counts conversations.
    """
    kept = _selected(turns, exclude, first)
    nested = nest_preferences(
        kept, max_turns=max_turns, probe=probe, skip_leading_system=skip_leading_system
    )
    return _extract(
        nested, lambda: P.turn_validity(kept), on_invalid, batch_size, skip_leading_system
    )


def pairs_from_rows(
    rows: DataFrame,
    exclude: str | None = EXCLUDED_SOURCE,
    first: int | None = None,
    on_invalid: str = "drop_conversation",
    batch_size: int = 1000,
    skip_leading_system: bool = False,
) -> DataFrame:
    """Pairs of nested preference rows; without a batch rule there is no shuffle."""
    nested = preference_rows(_selected(rows, exclude, first))
    return _extract(
        nested, lambda: P.pair_validity(nested), on_invalid, batch_size, skip_leading_system
    )


def _extract(
    nested: Nested,
    statuses: Callable[[], DataFrame],
    on_invalid: str,
    batch_size: int,
    skip_leading_system: bool,
) -> DataFrame:
    found = P.single_turn_pairs(nested, skip_leading_system)
    if on_invalid == "drop_conversation":
        return found
    if on_invalid == "drop_batch":
        return P.drop_bad_batches(found, statuses(), batch_size)
    raise ValueError(f"unknown on_invalid {on_invalid!r}")


def recovered(pairs: DataFrame) -> DataFrame:
    """Pairs with the prompt as it is found again in the rendered prompt: a prompt that
    holds a template marker comes back without what lies before or behind it."""
    found = P.rendered_prompts(pairs, chatml_spaced())
    return found.withColumn("prompt", F.col("recovered")).drop("rendered", "recovered")


def prepare(pairs: DataFrame, path: str, recover: bool = False) -> None:
    """Write pairs as chat-format JSONL, keys included; ``recover`` as in ``recovered``."""
    write_jsonl(P.chat_format(recovered(pairs) if recover else pairs), path)
