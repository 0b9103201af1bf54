"""What a training run sees: step plan, length budget, completion spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnloom.functions.folds import fold_list
from turnloom.functions.templates import Template
from turnloom.functions.text import count_tokens, first_tokens
from turnloom.operators.nest import Nested
from turnloom.operators.rank import hash_rank, order_hash

# A run over this many rows has at most this many bucket offsets plus 65,536.
BROADCAST_PLACES = 500_000


def step_plan(
    df: DataFrame,
    keys: Sequence[str],
    seed: int,
    batch_size: int,
    accumulation: int,
    max_steps: int,
) -> DataFrame:
    """``keys, step, slot`` of the rows a run of ``max_steps`` steps reads.

    Rows come in seeded order, ``batch_size * accumulation`` to a step. When the table
    is shorter than the run, it is gone through again in a new order per epoch. Only as
    many epochs as needed are laid out, and only rows the run reaches are shuffled.
    """
    if min(batch_size, accumulation, max_steps) < 1:
        raise ValueError("batch_size, accumulation and max_steps must be positive")
    per_step = batch_size * accumulation
    wanted = per_step * max_steps
    narrow = df.select(*keys)
    last_epoch = F.expr(f"({wanted} - 1) div _n")
    laid_out = (
        narrow.withColumn("_n", narrow.agg(F.count("*")).scalar())
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), last_epoch)))
        .withColumn("_hash", order_hash(keys, seed, F.col("_epoch").cast("string")))
    )
    # Epochs times rows is below wanted + n, hence few offsets: see BROADCAST_PLACES.
    few = wanted <= BROADCAST_PLACES
    ranked = hash_rank(laid_out, "_hash", keys, ["_epoch"], below=wanted, few_groups=few)
    place = F.col("_epoch") * F.col("_n") + F.col("rank")
    return (
        ranked.withColumn("_place", place)
        .filter(F.col("_place") < wanted)
        .select(
            *keys,
            F.expr(f"_place div {per_step}").alias("step"),
            (F.col("_place") % per_step).alias("slot"),
        )
    )


def length_budget(
    df: DataFrame, budget: int = 1024, text: str = "text", token_count_col: str | None = None
) -> DataFrame:
    """Add ``n_tokens``, ``over_budget`` and ``cut_text`` (the first ``budget`` tokens).

    Tokens are runs of non-space characters unless ``token_count_col`` holds true
    counts. The cut is then made only where the true count is over the budget, still at
    a run boundary.
    """
    n = count_tokens(F.col(text)) if token_count_col is None else F.col(token_count_col).cast("bigint")
    counted = df.withColumn("n_tokens", n).withColumn("over_budget", F.col("n_tokens") > budget)
    cut = F.when(F.col("over_budget"), first_tokens(F.col(text), budget)).otherwise(F.col(text))
    return counted.withColumn("cut_text", cut)


def completion_spans(nested: Nested, template: Template) -> DataFrame:
    """``conv_id, turn, start_pos, end_pos`` of assistant contents in the rendered text.

    Offsets are in characters, 0-based, end exclusive. The template must print the same
    number of characters around every content, so that lengths alone give the offsets.
    Conversations whose text is null have no spans.
    """
    if template.around_content is None:
        raise ValueError(f"{template.name} does not print messages in a fixed frame")
    header_chars, footer_chars = template.around_content
    lengths = F.transform(
        "messages",
        lambda m, i: F.struct(
            (F.col("first_pos") + i).alias("turn"),
            m["role"].alias("role"),
            (F.length(m["role"]) + header_chars).cast("bigint").alias("lead"),
            F.length(m["content"]).cast("bigint").alias("body"),
        ),
    )
    printed = template.body(F.col("messages"), None).isNotNull()
    sized = nested.map(
        lambda df: df.select("conv_id", "first_pos", printed.alias("_ok"), lengths.alias("sized"))
    )
    df = sized.whole.withColumn("_base", F.lit(0).cast("bigint"))
    if sized.parts is not None:
        df = df.unionByName(_with_base(sized.parts, footer_chars))
    df = df.filter("_ok")
    span = "struct<turn:bigint,start_pos:bigint,end_pos:bigint>"

    def place(at: Column, m: Column) -> Column:
        begin = at + m["lead"]
        found = F.struct(
            m["turn"].alias("turn"), begin.alias("start_pos"), (begin + m["body"]).alias("end_pos")
        )
        return F.when(m["role"] == "assistant", found)

    def advance(at: Column, m: Column) -> Column:
        return at + m["lead"] + m["body"] + footer_chars

    found = fold_list(F.col("sized"), F.col("_base"), place, advance, span)
    return df.select("conv_id", F.inline(F.filter(found, lambda x: x.isNotNull())))


def _with_base(parts: DataFrame, footer_chars: int) -> DataFrame:
    """Add to each part of a long conversation the length of the parts before it."""
    row_chars = F.aggregate(
        "sized", F.lit(0).cast("bigint"), lambda a, m: a + m["lead"] + m["body"] + footer_chars
    )
    conversation = W.partitionBy("conv_id")
    upto = F.sum("_chars").over(conversation.orderBy("first_pos"))
    narrow = parts.select("conv_id", "first_pos", "_ok", row_chars.alias("_chars"))
    bases = narrow.select(
        "conv_id",
        "first_pos",
        F.bool_and("_ok").over(conversation).alias("_ok"),
        (upto - F.col("_chars")).alias("_base"),
    )
    return parts.drop("_ok").join(bases, ["conv_id", "first_pos"])
