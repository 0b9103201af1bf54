"""Chat-format pairs to what a preference training run reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnloom.functions.templates import Template
from turnloom.operators.nest import SIDES
from turnloom.operators.pairs import render_pairs
from turnloom.operators.shaping import BROADCAST_PLACES, length_budget, step_plan
from turnloom.operators.splits import exact_split
from turnloom.session import shared_dir

KEYS = ("conv_id", "pair_idx")


def training_rows(
    chat: DataFrame,
    template: Template,
    split_seed: int = 42,
    eval_share: tuple[int, int] = (3, 10),
    run_seed: int = 35,
    batch_size: int = 2,
    accumulation: int = 4,
    max_steps: int = 120,
    budget: int = 1024,
) -> DataFrame:
    """Rendered train pairs with step and slot, and the length check of both answers.

    Split and plan are made on stored keys alone. Only rows the run reaches, at most
    ``batch_size * accumulation * max_steps``, are then looked up and rendered.
    """
    shared_dir(chat.sparkSession)
    keys = chat.select(*KEYS).checkpoint()
    train = exact_split(keys, KEYS, split_seed, eval_share).filter(F.col("split") == "train")
    plan = step_plan(train, KEYS, run_seed, batch_size, accumulation, max_steps).checkpoint()
    wanted = plan.select(*KEYS).distinct()
    if batch_size * accumulation * max_steps <= BROADCAST_PLACES:
        wanted = F.broadcast(wanted)
    rendered = render_pairs(chat.join(wanted, list(KEYS), "left_semi"), [template])
    for side in SIDES:
        rendered = length_budget(rendered, budget, text=side).withColumnsRenamed(
            {"n_tokens": f"{side}_tokens", "over_budget": f"{side}_over", "cut_text": f"{side}_cut"}
        )
    return plan.join(rendered, list(KEYS))
