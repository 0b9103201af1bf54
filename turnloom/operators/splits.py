"""Train/eval splits, overlap audit and balanced samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnloom.operators.rank import counted_broadcast, hash_cutoff, order_hash
from turnloom.operators.select import in_prefix

# Spark prunes ranks up to spark.sql.optimizer.windowGroupLimitThreshold (1,000) before a shuffle.
PRUNED = 1000


def exact_split(
    df: DataFrame,
    keys: Sequence[str],
    seed: int = 42,
    eval_share: tuple[int, int] = (3, 10),
    split: str = "split",
) -> DataFrame:
    """Add ``split``: exactly ``ceil(share * n)`` rows are ``eval``, the rest ``train``.

    The share is a fraction of integers. The eval rows are those with the lowest seeded
    hash of their key, so the split is the same under any partitioning. The job fails if
    equal keys lie across the cut. The input is read three times (histogram, cut, result):
    store it first if it is costly to compute.
    """
    num, den = (int(x) for x in eval_share)
    if not 0 <= num <= den or den < 1:
        raise ValueError("eval_share must be a fraction between 0 and 1")
    if num == 0:
        return df.withColumn(split, F.lit("train"))
    quota = F.expr(f"({num} * _total + {den - 1}) div {den}")
    flagged = hash_cutoff(df, keys, seed, quota, "_eval")
    return flagged.withColumn(split, F.when(F.col("_eval"), "eval").otherwise("train")).drop("_eval")


def prefix_split(
    df: DataFrame, key: str, n_eval: int, mode: str = "overlap", split: str = "split"
) -> DataFrame:
    """Eval is the first ``n_eval`` keys in key order.

    ``overlap``: train is everything, so eval rows come out twice. ``disjoint``: train is
    the rest. One pass either way.
    """
    if mode not in ("overlap", "disjoint"):
        raise ValueError(f"unknown mode {mode!r}")
    in_eval = F.array(F.lit("eval"), F.lit("train")) if mode == "overlap" else F.array(F.lit("eval"))
    names = F.when(in_prefix(df, key, n_eval), in_eval).otherwise(F.array(F.lit("train")))
    return df.withColumn(split, F.explode(names))


def overlap_audit(df: DataFrame, key: str, text: str = "text", split: str = "split") -> DataFrame:
    """One row: eval rows, and how many of them share a key or a text with train.

    Texts are compared by md5. Rows are first folded to one row per key or hash, on the
    map side too, so a text with very many copies is counted, not gathered.
    """
    marks = df.select(
        split,
        F.inline(
            F.array(
                F.struct(F.lit("key").alias("kind"), F.col(key).cast("string").alias("value")),
                F.struct(F.lit("text").alias("kind"), F.md5(text).alias("value")),
            )
        ),
    )
    shared = marks.groupBy("kind", "value").agg(
        F.count_if(F.col(split) == "eval").alias("n_eval"),
        F.count_if(F.col(split) == "train").alias("n_train"),
    )
    both = (F.col("n_train") > 0) & F.col("value").isNotNull()

    def total(kind: str, also: Column) -> Column:
        hit = F.when((F.col("kind") == kind) & also, F.col("n_eval"))
        return F.coalesce(F.sum(hit), F.lit(0)).cast("bigint")

    return shared.agg(
        total("key", F.lit(True)).alias("n_eval"),
        total("key", both).alias("n_key_overlap"),
        total("text", both).alias("n_text_overlap"),
    )


def balanced_sample(
    df: DataFrame, stratum: str, keys: Sequence[str], per_stratum: int, seed: int = 42
) -> DataFrame:
    """The rows of the ``per_stratum`` lowest keys of each stratum in seeded hash order.

    With unique keys that is at most ``per_stratum`` rows; rows that share a key are taken
    together. Up to ``PRUNED`` keys, each task keeps the lowest keys of each stratum before
    anything is shuffled; a table of keys alone is then done, rows with other columns are compared
    with the last key of their stratum. For larger samples the last key is found by a histogram (see
    ``hash_cutoff``). A hot stratum is never sorted whole in one task, and complete rows are not
    sorted at all.
    """
    if per_stratum < 1:
        return df.limit(0)
    known = F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum")
    tagged = df.select("*", F.struct(F.col(stratum).isNull().alias("none"), known).alias("_group"))
    if per_stratum <= PRUNED:
        hashed = tagged.withColumn("_hash", order_hash(keys, seed))
        lowest = F.dense_rank().over(W.partitionBy("_group").orderBy("_hash", *keys))
        if set(df.columns) <= {stratum, *keys}:
            found = hashed.withColumn("_nth", lowest).filter(F.col("_nth") <= per_stratum)
            return found.select(*df.columns)
        place = F.struct("_hash", *keys)
        ranked = hashed.select("_group", *keys, "_hash").withColumn("_nth", lowest)
        last = ranked.filter(F.col("_nth") <= per_stratum).groupBy("_group").agg(F.max(place).alias("_last"))
        return (
            hashed.join(counted_broadcast(last), "_group")
            .filter(place <= F.col("_last"))
            .select(*df.columns)
        )
    picked = hash_cutoff(
        tagged, keys, seed, F.lit(per_stratum), "_picked", ["_group"], repeated="together"
    )
    return picked.filter("_picked").drop("_picked", "_group")
