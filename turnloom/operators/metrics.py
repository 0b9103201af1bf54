"""Preference metrics over logged log-probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def margin(beta: float) -> Column:
    """Reward margin: beta times the gap in policy-to-reference log-ratios."""
    chosen = F.col("policy_chosen") - F.col("ref_chosen")
    rejected = F.col("policy_rejected") - F.col("ref_rejected")
    return F.lit(beta) * (chosen - rejected)


def sigmoid_loss(m: Column) -> Column:
    """-ln(sigmoid(m)), written so that large margins of either sign do not overflow."""
    return F.greatest(-m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))


def preference_metrics(df: DataFrame, by: Sequence[str], beta: float = 0.1) -> DataFrame:
    """Per group: row count, share of positive margins, mean margin and mean loss.

    Plain sums, combined on the map side: a hot group costs no more than others.
    """
    m = F.col("_margin")
    return (
        df.withColumn("_margin", margin(beta))
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.avg((m > 0).cast("double")).alias("accuracy"),
            F.avg(m).alias("mean_margin"),
            F.avg(sigmoid_loss(m)).alias("mean_loss"),
        )
    )
