"""Views over the given tables in the shapes the operators take (FIXTURES.md, F1-F6).

The conversations table has clean data only; the views add the cases worth testing
(unknown roles, missing sources, padded, edited and blank texts, missing turns) by rules
on the keys, as equi-joins and projections over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnloom.functions.templates import EOS, IM_END, chatml_compact
from turnloom.operators.nest import SIDES, nest_preferences, nest_turns
from turnloom.plans.preference import EXCLUDED_SOURCE
from turnloom.schemas import message
from turnloom.sources.readers import read_turns

SYSTEM_PROMPTS = (
    (0, "Answer in one short paragraph and say so when you are unsure."),
    (1, "Think step by step, then give the final answer on its own line."),
)


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_turns(spark, f"{sf_dir}/conversations.parquet")


def turns_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns a minute apart, and one much later that moves the watermark past all of them."""
    timed = turns(spark, sf_dir).filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        "role",
        "content",
        F.timestamp_seconds(F.col("conv_id") * 100 + F.col("turn") * 60).alias("at"),
    )
    last = timed.agg(F.max("at").alias("at")).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("turn"),
        F.lit("system").alias("role"),
        F.lit("end").alias("content"),
        (F.col("at") + F.expr("INTERVAL 30 DAYS")).alias("at"),
    )
    return timed.unionByName(last.filter("at is not null"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def sharegpt_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, turn, from, value`` with one role that is not a known one."""
    odd = (F.col("conv_id") % 13 == 5) & (F.col("turn") == 1)
    name = (
        F.when(odd, "tool")
        .when(F.col("role") == "user", "human")
        .when(F.col("role") == "assistant", "gpt")
        .otherwise(F.col("role"))
    )
    return turns(spark, sf_dir).select(
        "conv_id", "turn", name.alias("from"), F.col("content").alias("value")
    )


def turns_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of which some have no content."""
    lost = (F.col("conv_id") % 7 == 3) & (F.col("turn") == 1)
    return turns(spark, sf_dir).withColumn("content", F.when(~lost, F.col("content")))


def turns_with_late_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of which every other conversation lacks a content, late ones too."""
    lost = (F.col("conv_id") % 2 == 0) & (F.col("turn") == 1)
    return turns(spark, sf_dir).withColumn("content", F.when(~lost, F.col("content")))


def with_markers(base: DataFrame) -> DataFrame:
    """Turns of which some user messages hold template markers."""
    marked = (F.col("role") == "user") & (F.col("conv_id") % 9 == 4)
    marks = F.lit("q <|im_start|>user \nmid <|im_end|> tail ")
    return base.withColumn(
        "content", F.when(marked, F.concat(marks, "content")).otherwise(F.col("content"))
    )


def sharegpt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as it is published: one row per conversation, without a key."""
    named = sharegpt_turns(spark, sf_dir).withColumnsRenamed({"from": "role", "value": "content"})
    nested = nest_turns(named, max_turns=None).whole
    said = F.transform(
        "messages", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value"))
    )
    return nested.select(said.alias("conversations"))


def preference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 as it is published: one row per conversation, without a key."""
    nested = nest_preferences(preference_turns(spark, sf_dir), max_turns=None).whole
    return nested.select("source", *SIDES)


def source_of(conv_id: Column) -> Column:
    return F.when(conv_id % 10 == 0, EXCLUDED_SOURCE).when(
        conv_id % 10 != 1, F.concat(F.lit("src"), (conv_id % 20).cast("string"))
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, source``, one row per conversation."""
    ids = turns(spark, sf_dir).select("conv_id").distinct()
    return ids.withColumn("source", source_of(F.col("conv_id")))


def preference_turns(spark: SparkSession, sf_dir: str, markers: bool = False) -> DataFrame:
    """``conv_id, source, side, turn, role, content``."""
    base = turns(spark, sf_dir)
    base = with_markers(base) if markers else base
    c, t, role, content = (F.col(x) for x in ("conv_id", "turn", "role", "content"))
    # The answer of the next conversation at the same turn serves as rejected answer.
    other = base.filter(role == "assistant").select(
        (c - 1).alias("conv_id"), "turn", content.alias("other")
    )
    # The last turn is found by its own key, so that no conversation meets in one task.
    last = base.filter(c % 17 == 4).groupBy("conv_id").agg(F.max("turn").alias("turn"))
    last = last.withColumn("cut", F.lit(True))
    answer, ask, is_chosen = role == "assistant", role == "user", F.col("side") == "chosen"
    chosen_content = F.when(answer & (t == 1) & (c % 11 == 6), F.lit("   \n")).otherwise(content)
    rejected_role = F.when(answer & (t == 1) & (c % 13 == 5), "tool").otherwise(role)
    rejected_content = (
        F.when(answer, F.coalesce("other", content))
        .when(ask & (c % 5 == 2), F.concat(F.lit("\t "), content, F.lit("\xa0")))
        .when(ask & (c % 7 == 3), F.concat(content, F.lit(" (edited)")))
        .otherwise(content)
    )
    sides = F.when(F.col("cut"), F.array(F.lit("chosen"))).otherwise(F.array(*map(F.lit, SIDES)))
    return (
        base.join(other, ["conv_id", "turn"], "left")
        .join(last, ["conv_id", "turn"], "left")
        .select("*", F.explode(sides).alias("side"))
        .select(
            "conv_id",
            source_of(c).alias("source"),
            "side",
            "turn",
            F.when(is_chosen, role).otherwise(rejected_role).alias("role"),
            F.when(is_chosen, chosen_content).otherwise(rejected_content).alias("content"),
        )
    )


def logged_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, turn, prompt, output`` of each assistant turn.

    The prompt is the leading system message, if there is one, and the turn before, ready
    for generation.
    """
    base = turns(spark, sf_dir)
    leading = base.filter((F.col("role") == "system") & (F.col("turn") == 0)).groupBy("conv_id").agg(
        F.first(message("role", "content")).alias("system")
    )
    before = base.select(
        "conv_id", (F.col("turn") + 1).alias("turn"), message("role", "content").alias("m")
    )
    answers = base.filter(F.col("role") == "assistant").select("conv_id", "turn", "content")
    asked = F.filter(
        F.array(F.when(F.col("turn") > 1, F.col("system")), F.col("m")), lambda m: m.isNotNull()
    )
    return (
        answers.join(before, ["conv_id", "turn"], "left")
        .join(leading, "conv_id", "left")
        .withColumn("prompt", chatml_compact().text(asked, generation=True))
        .select(
            "conv_id",
            "turn",
            "prompt",
            F.concat("prompt", F.lit("  "), "content", F.lit(IM_END + EOS)).alias("output"),
        )
    )


def log_probs(pairs: DataFrame) -> DataFrame:
    """four log-probabilities per pair, made from integers."""
    size = {s: F.length(s) for s in SIDES}
    c = F.col("conv_id")
    return pairs.withColumns(
        {
            "policy_chosen": -size["chosen"] / F.lit(100.0),
            "ref_chosen": -(size["chosen"] + c % 7) / F.lit(100.0),
            "policy_rejected": -size["rejected"] / F.lit(100.0),
            "ref_rejected": -(size["rejected"] + c % 5) / F.lit(100.0),
        }
    ).drop("prompt", *SIDES)
