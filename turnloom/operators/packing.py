"""Sequence packing: rows of known lengths into bins of a fixed budget.

Best-fit decreasing places the longest row first, each into the fullest bin it fits into. Rows
of one length are alike, so the placement runs over a histogram of lengths (at most ``budget``
classes) instead of rows: whole runs of equal bins are filled at once. Rows then find their bin
by their rank within their class, so no list of rows is ever gathered. The plan is small: a run of
bins with room r is left with less than r / 2 whenever it is touched, hence at most
3 * budget * log2(budget) segments, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from turnloom.operators.rank import hash_rank, order_hash

# length, rank of the first row, rank after the last one, first bin, rows a bin, place in the bin
PLAN = "length bigint, low bigint, high bigint, bin bigint, each bigint, start bigint"


@dataclass
class Run:
    """``count`` bins from ``first`` on, each filled up to ``fill``."""

    first: int
    count: int
    fill: int


def plan_bins(histogram: Iterable[tuple[int, int]], budget: int) -> tuple[list[tuple], int]:
    """Segments of ``PLAN`` and the number of bins, for (length, rows) pairs."""
    open_bins: dict[int, list[Run]] = {}  # by the room that is left
    segments, n_bins = [], 0
    for length, left in sorted(histogram, reverse=True):
        placed, room = 0, length
        while left:
            while room < budget and not open_bins.get(room):
                room += 1
            runs = open_bins.get(room)
            fits = room // length
            if runs:
                run = runs.pop()
            else:
                run = Run(n_bins, -(-left // fits), 0)
                n_bins += run.count
            full = min(run.count, left // fits)
            rest = min(left - full * fits, fits) if full < run.count else 0
            for count, each, first in ((full, fits, run.first), (bool(rest), rest, run.first + full)):
                if count:
                    taken = count * each
                    segments.append((length, placed, placed + taken, first, each, run.fill))
                    placed, left = placed + taken, left - taken
                    after = Run(first, int(count), run.fill + each * length)
                    open_bins.setdefault(budget - after.fill, []).append(after)
            used = full + bool(rest)
            if used < run.count:
                open_bins.setdefault(room, []).append(Run(run.first + used, run.count - used, run.fill))
    return segments, n_bins


def pack_sequences(
    df: DataFrame, keys: Sequence[str], length: str, budget: int, seed: int = 42
) -> DataFrame:
    """Add ``bin`` and ``start_pos`` (0-based place in the bin) to each row.

    Lengths above ``budget`` count as ``budget``: such a row has a bin of its own. Rows without
    a length, or with one below 1, have neither bin nor place. ``keys`` must tell rows apart.
    The input is read three times (histogram, ranks, result): store it first if it is costly.
    """
    if budget < 1:
        raise ValueError("budget must be positive")
    own = F.col(length).cast("bigint")
    sized = df.withColumn("_length", F.when(own > budget, budget).otherwise(own))
    known = F.col("_length") >= 1
    # At most ``budget`` rows reach the driver.
    histogram = [
        (r["_length"], r["n"])
        for r in sized.filter(known).groupBy("_length").agg(F.count("*").alias("n")).collect()
    ]
    segments, _ = plan_bins(histogram, budget)
    plan = F.broadcast(df.sparkSession.createDataFrame(segments, PLAN).withColumnRenamed("length", "_length"))
    hashed = sized.filter(known).withColumn("_hash", order_hash(keys, seed))
    ranked = hash_rank(hashed, "_hash", keys, ["_length"], rank="_rank")
    inside = (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    nth = F.col("_rank") - F.col("low")
    found = (
        ranked.join(plan, "_length")
        .filter(inside)
        .withColumn("_bin", F.expr("bin + (_rank - low) div each"))
        .withColumn("_start", F.col("start") + nth % F.col("each") * F.col("_length"))
        .select(*df.columns, F.col("_bin").alias("bin"), F.col("_start").alias("start_pos"))
    )
    none = F.lit(None).cast("bigint")
    rest = sized.filter(~F.coalesce(known, F.lit(False)))
    return found.unionByName(rest.select(*df.columns, none.alias("bin"), none.alias("start_pos")))


def least_bins(histogram: Iterable[tuple[int, int]], budget: int) -> int:
    """A lower bound of the number of bins: rows too long to share a bin, and the room that the
    others need beyond what is left beside them (the best of all thresholds)."""
    rows = sorted(histogram)
    best = 0
    for threshold in {0, *(n for n, _ in rows if 2 * n <= budget)}:
        alone = sum(c for n, c in rows if n > budget - threshold)
        large = [(n, c) for n, c in rows if budget / 2 < n <= budget - threshold]
        small = sum(n * c for n, c in rows if threshold <= n and 2 * n <= budget)
        room = sum((budget - n) * c for n, c in large)
        more = max(0, -(-(small - room) // budget))
        best = max(best, alone + sum(c for _, c in large) + more)
    return best
