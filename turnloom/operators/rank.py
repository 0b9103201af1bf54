"""Exact ranks and exact lowest-k selections without a one-partition window.

Two orders are served:

* ``range_rank`` ranks in the order of given columns. Rows are range-partitioned on the
  whole order, so a hot prefix value is spread over partitions, then numbered inside
  each partition and shifted by the sizes of the partitions before.
* ``hash_cutoff`` and ``hash_rank`` work in the order of a seeded md5 of the key, used
  for random splits and samples. The first hex digits of the hash are the bucket, a
  pure function of the row, so results do not depend on partitioning or retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnloom.session import fresh_path, shared_dir

HEX_DIGITS = 4  # 16 ** 4 = 65,536 buckets
BROADCAST_ROWS = 100_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def counted_broadcast(df: DataFrame) -> DataFrame:
    """Store a narrow table; broadcast it if counting shows at most BROADCAST_ROWS."""
    shared_dir(df.sparkSession)
    stored = df.checkpoint()
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def range_rank(
    df: DataFrame,
    order: Sequence[str],
    rank: str = "rank",
    bounds: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in ascending ``order``.

    Range bounds are found from samples that pass through the driver. Where ``order`` ends
    with long texts, ``bounds`` names columns that grow with it and are short.

    The sampled range bounds must be the same for the partition sizes and for the rows,
    so the sorted rows are written to the shared folder first. The table is columnar:
    the sizes are then read from the row numbers alone.
    """
    row_id, part, size, before = "_row_id", "_part", "_size", "_before"
    path = fresh_path(df.sparkSession, "rank")
    (
        df.repartitionByRange(*(bounds or order))
        .sortWithinPartitions(*order)
        .withColumn(row_id, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    placed = df.sparkSession.read.parquet(path).withColumn(part, F.shiftright(row_id, _ROW_BITS))
    sizes = placed.groupBy(part).agg(F.count("*").alias(size))
    # One row per partition of the exchange: a window over it and a broadcast of it are
    # bounded by the partition count, not by the data.
    running = F.sum(size).over(W.orderBy(part)) - F.col(size)
    offsets = sizes.select(part, running.alias(before))
    in_part = F.col(row_id).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), part)
        .withColumn(rank, F.col(before) + in_part)
        .drop(row_id, part, before)
    )


def order_hash(keys: Sequence[str], *seed: int | str | Column) -> Column:
    """md5 of ``seed:key:key``; a null key is an error, since it would have no place."""
    parts = [s if isinstance(s, Column) else F.lit(str(s)) for s in seed]
    parts += [
        F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null key {k}")).cast("string")).otherwise(
            F.col(k).cast("string")
        )
        for k in keys
    ]
    return F.md5(F.concat_ws(":", *parts))


def _bucket(hash_col: str) -> Column:
    return F.substring(hash_col, 1, HEX_DIGITS)


def _edges(hashed: DataFrame, groups: Sequence[str], quota: Column) -> DataFrame:
    """Per group, the bucket in which the quota runs out and how many rows it still gives.

    The histogram is aggregated before it is shuffled and has at most 65,536 rows per
    group, however many rows of the data share one group.
    """
    counts = hashed.groupBy(*groups, _bucket("_hash").alias("_bucket")).agg(
        F.count("*").alias("_n")
    )
    whole = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(0))
    upto = F.sum("_n").over(whole.orderBy("_bucket"))
    return (
        counts.withColumn("_upto", upto)
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_quota", F.least(quota, F.col("_total")))
        .filter((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
        .select(*groups, "_bucket", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_need"))
    )


def hash_cutoff(
    df: DataFrame,
    keys: Sequence[str],
    seed: int,
    quota: Column,
    flag: str,
    groups: Sequence[str] = (),
    repeated: str = "refuse",
) -> DataFrame:
    """Flag the ``quota`` lowest rows of each group in seeded hash order, exactly.

    ``quota`` may use the column ``_total``, the row count of the group. Only the last
    selected row of each group has to be found; it is looked up in the one hash bucket
    where the quota runs out. All other rows are then compared with it, so the table
    itself is never sorted and, without groups, not shuffled either.

    Rows with equal keys have one place in the order. ``repeated="refuse"``: the job fails if
    such a place lies across the cut, since no exact cut exists. ``repeated="together"``:
    places are counted instead of rows, and all rows of a chosen place are flagged.
    """
    if repeated not in ("refuse", "together"):
        raise ValueError(f"unknown rule for repeated keys {repeated!r}")
    hashed = df.withColumn("_hash", order_hash(keys, seed))
    place = F.struct("_hash", *keys)
    places = hashed.select(*dict.fromkeys([*groups, *keys]), "_hash")
    if repeated == "together":
        places = places.distinct()
    edges = _edges(places, groups, quota)
    if not groups:
        edges = F.broadcast(edges)  # a single row
    in_edge = places.withColumn("_bucket", _bucket("_hash")).join(edges, [*groups, "_bucket"])
    in_order = W.partitionBy(*groups, "_bucket").orderBy("_hash", *keys)
    torn = F.coalesce(F.lead(place).over(in_order) == place, F.lit(False))
    refused = F.raise_error(F.lit(f"keys {list(keys)} repeat across the cut"))
    last = (
        in_edge.withColumn("_torn", torn)
        .withColumn("_nth", F.row_number().over(in_order))
        .filter(F.col("_nth") == F.col("_need"))
        .select(*groups, F.when(F.col("_torn"), refused.cast("void")).otherwise(place).alias("_last"))
    )
    if groups:
        last = counted_broadcast(last)
        picked = hashed.join(last, list(groups), "left").withColumn(
            flag, F.coalesce(place <= F.col("_last"), F.lit(False))
        )
    else:
        picked = hashed.withColumn(flag, F.coalesce(place <= last.scalar(), F.lit(False)))
    return picked.drop("_hash", "_last")


def hash_rank(
    df: DataFrame,
    hash_col: str,
    keys: Sequence[str],
    groups: Sequence[str] = (),
    below: int | None = None,
    few_groups: bool = False,
    rank: str = "rank",
) -> DataFrame:
    """Add the 0-based rank in ``hash_col`` order within each group.

    With ``below``, buckets that lie wholly beyond it are left out. If the caller knows
    that there are ``few_groups``, the bucket offsets (at most 65,536 per group) are
    broadcast, and rows of those buckets are left out before anything is shuffled: asking
    for the first few thousand ranks then moves only about as many rows.
    """
    bucketed = df.withColumn("_bucket", _bucket(hash_col))
    counts = bucketed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    whole = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(0))
    offsets = counts.select(
        *groups,
        "_bucket",
        (F.sum("_n").over(whole.orderBy("_bucket")) - F.col("_n")).alias("_before"),
    )
    if below is not None:
        offsets = offsets.filter(F.col("_before") < below)
    if few_groups:
        offsets = F.broadcast(offsets)
    nth = F.row_number().over(W.partitionBy(*groups, "_bucket").orderBy(hash_col, *keys))
    ranked = (
        bucketed.join(offsets, [*groups, "_bucket"])
        .withColumn(rank, F.col("_before") + nth - 1)
        .drop("_bucket", "_before")
    )
    return ranked if below is None else ranked.filter(F.col(rank) < below)
