"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Rows are first dealt to blocks, a pure function of the row, so that a lost task gives the
same rows again. For each block the numbers of rows it sends to every shard are drawn from
the multivariate hypergeometric law, block after block from what is left of the shards:
exactly the counts that a uniformly random permutation of all rows would have. Then each
block is permuted locally (order of a seeded md5), its rows are dealt to the shards by the
counts, and each shard is permuted again for the slots.

The driver holds the matrix only: at most ``MAX_CELLS`` numbers, whatever the number of
rows. Slots are positions in hash buckets of a shard plus the sizes of the buckets before,
so a shard of any size is never sorted in one task.

Defined results: a null text has 16 bytes and checksum 0; rows with equal doc_id are
separate rows; an empty table gives no rows; other columns are kept by ``shard_rows``
(names that begin with ``_shard`` are used here and must not occur). Equal texts are not kept
together: the permutation is uniform over rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

from turnloom.llm.common import hex_digits, table

SHARDS = 40
ROWS_PER_BLOCK = 20_000
MAX_CELLS = 2_000_000
ROWS_PER_BUCKET = 256


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Number of good ones among ``draws`` out of ``good + bad``, for totals of any size.

    Inversion over all values within twelve standard deviations of the mean, with the
    probabilities from their ratios.
    """
    total = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mean = draws * (good / total)
    spread = math.sqrt(mean * (bad / total) * ((total - draws) / max(total - 1, 1)))
    low = max(low, math.floor(mean - 12 * spread - 20))
    high = min(high, math.ceil(mean + 12 * spread + 20))
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    upto = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(upto, rng.random() * upto[-1], side="right"))


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Counts per block and shard; rows sum to ``sizes``, columns differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(sizes)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((len(sizes), shards), dtype=np.int64)
    for block, size in enumerate(sizes):
        rest = sum(left)
        for s in range(shards):
            if not size:
                break
            n = draw_hypergeometric(rng, left[s], rest - left[s], size)
            rest -= left[s]
            left[s] -= n
            size -= n
            out[block, s] = n
    return out


def shard_rows(
    rows: DataFrame, shards: int = SHARDS, seed: int = 0, key: str = "doc_id"
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0)."""
    spark = rows.sparkSession
    n = rows.count()
    blocks = max(1, min(math.ceil(n / ROWS_PER_BLOCK), MAX_CELLS // shards))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    tie = [F.col(f"`{c}`") for c, kind in rows.dtypes if c != key and kind in ("bigint", "int")]
    placed = rows.withColumn("_shard_block", F.pmod(F.xxhash64(name, F.lit(seed)), F.lit(blocks)))
    counted = dict(placed.groupBy("_shard_block").count().collect())
    matrix = communication_matrix([counted.get(b, 0) for b in range(blocks)], shards, seed)
    ends = spark.createDataFrame(
        [(b, row.tolist()) for b, row in enumerate(np.cumsum(matrix, axis=1))],
        "_shard_block long, _shard_ends array<long>",
    )
    first = F.md5(F.concat_ws(":", F.lit(f"{seed}-local"), name))
    second = F.md5(F.concat_ws(":", F.lit(f"{seed}-slot"), name))
    local = F.row_number().over(W.partitionBy("_shard_block").orderBy(first, name, *tie))
    at = F.col("_shard_local")
    dealt = (
        placed.withColumn("_shard_local", local)
        # At most MAX_CELLS numbers.
        .join(F.broadcast(ends), "_shard_block")
        .withColumn("shard", F.size(F.filter("_shard_ends", lambda end: end < at)))
        .withColumn("_shard_hash", second)
        .withColumn(
            "_shard_bucket",
            F.substring("_shard_hash", 1, hex_digits(n // shards, ROWS_PER_BUCKET)),
        )
        .drop("_shard_ends", "_shard_block", "_shard_local")
    )
    # At most one row per shard and bucket; one shard's buckets stand in one window.
    per_bucket = dealt.groupBy("shard", "_shard_bucket").agg(F.count("*").alias("_shard_n"))
    upto = F.sum("_shard_n").over(W.partitionBy("shard").orderBy("_shard_bucket"))
    before = per_bucket.select("shard", "_shard_bucket", (upto - F.col("_shard_n")).alias("_shard_before"))
    nth = F.row_number().over(
        W.partitionBy("shard", "_shard_bucket").orderBy("_shard_hash", name, *tie)
    )
    return (
        dealt.withColumn("_shard_nth", nth)
        .join(before, ["shard", "_shard_bucket"])
        .withColumn("slot", (F.col("_shard_before") + F.col("_shard_nth") - 1).cast("long"))
        .drop("_shard_hash", "_shard_bucket", "_shard_nth", "_shard_before")
    )


def op4_hypergeometric(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return shard_rows(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
