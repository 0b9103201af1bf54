"""Splits without leaks: rows that share a key or a text are on one side.

Keys and texts are the two sides of a graph; its components are the units of the split. Almost
all rows of a large table share nothing: a unit of their own is told from two counts, and only
the others go through rounds of least labels. A subset sum over the histogram of unit sizes says
how many units of each size make up the eval part; which ones is decided by their seeded hash. So
neither rows nor units pass through the driver, only the sizes that occur (fewer than the square
root of twice the rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from turnloom.operators.rank import counted_broadcast, hash_cutoff, order_hash
from turnloom.session import shared_dir

# Edges of one text from which its label is sent instead of shuffled: such texts are few.
HOT_EDGES = 100_000
# Sums that the search for a plan may tell apart, over all sizes: 25 MB of bits.
PLAN_BITS = 200_000_000


def key_units(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``key, n, unit``: one row per key (its md5), with its rows and its unit. Units are equal for
    keys whose rows share a text, directly or through other rows, and different otherwise.

    The unit is the least md5 of a key in it. A null text is shared with nothing; a null key is
    an error. Texts are compared by md5. An empty table gives no rows.
    """
    shared_dir(df.sparkSession)
    hashed = df.select(order_hash(keys, "").alias("key"), F.md5(text).alias("t"))
    counts = hashed.groupBy("key", "t").agg(F.count("*").alias("rows")).checkpoint()
    # A text of one key joins nothing.
    edges = counts.filter("t is not null").select(F.col("key").alias("k"), "t")
    texts = edges.groupBy("t").agg(F.count("*").alias("n")).filter("n > 1")
    labels = _least_labels(edges.join(texts.hint("merge"), "t").checkpoint())
    whole = counts.groupBy("key").agg(F.sum("rows").alias("n"))
    known = counted_broadcast(labels.withColumnRenamed("k", "key"))
    return whole.join(known, "key", "left").select(
        "key", "n", F.coalesce("label", "key").alias("unit")
    )


def split_units(df: DataFrame, keys: Sequence[str], text: str, out: str = "unit") -> DataFrame:
    """``df`` with its rows' units as ``out``; see ``key_units``. A column of that name is replaced."""
    found = key_units(df, keys, text).select(F.col("key").alias("_key"), F.col("unit").alias("_unit"))
    return _with_units(df.drop(out), keys, found, {out: F.col("_unit")})


def _with_units(df: DataFrame, keys: Sequence[str], found: DataFrame, made: dict[str, Column]) -> DataFrame:
    """``df`` with columns ``made`` of ``found``, by the hash of its keys: the one shuffle of whole rows."""
    clash = sorted(set(df.columns) & set(found.columns))
    if clash:
        raise ValueError(f"columns {clash} have names that are used here")
    own = df.select("*", order_hash(keys, "").alias("_key"))
    return own.join(found, "_key", "left").select(
        *(F.col(f"`{c}`") for c in df.columns), *(c.alias(n) for n, c in made.items())
    )


def _least_labels(edges: DataFrame) -> DataFrame:
    """``k, label``: the least k that is reachable over shared t.

    Every text takes the least label of its keys, every key the least of its texts, then a
    label is replaced by the label of the key that it names, until nothing changes. A text with very many
    keys is aggregated on the map side, and its label is broadcast rather than joined. All else is
    merged: a table small enough for Spark to broadcast would pass through the driver in every round.
    """
    hot = edges.filter(f"n >= {HOT_EDGES}")
    parts = [edges] if hot.isEmpty() else [edges.filter(f"n < {HOT_EDGES}"), hot]
    labels = edges.select("k").distinct().withColumn("label", F.col("k"))
    while True:
        sent = []
        for k, part in enumerate(parts):
            least = part.join(labels.hint("merge"), "k").groupBy("t").agg(F.min("label").alias("label"))
            sent.append(part.select("k", "t").join(counted_broadcast(least) if k else least.hint("merge"), "t"))
        known = sent[0] if len(sent) == 1 else sent[0].unionByName(sent[1])
        least = known.groupBy("k").agg(F.min("label").alias("label")).checkpoint()
        named = least.select(F.col("k").alias("label"), F.col("label").alias("next"))
        old = labels.withColumnRenamed("label", "old")
        labels = least.join(named.hint("merge"), "label").select("k", F.least("label", "next").alias("label")).checkpoint()
        if labels.join(old.hint("merge"), "k").filter("label != old").isEmpty():
            return labels


def plan_sizes(histogram: dict[int, int], target: int) -> tuple[dict[int, int], bool]:
    """How many units of each size to take so that they hold ``target`` rows, or the nearest number
    that is possible (the lower of two), and whether this is proved.

    First each size gives its share of the target, rounded down, so that the eval part is mixed as
    the table; the rest is filled from the units that are left, largest first, which hits the target
    wherever small units are not rare. If it does not, a subset sum over those units, then one over all
    units is searched. Only where these would need more than ``PLAN_BITS`` sums, so where many
    millions of rows lie in large units alone, does an answer stand unproved.
    """
    total = sum(size * n for size, n in histogram.items())
    if not 0 <= target <= total:
        raise ValueError("the target must lie between no rows and all")
    base = {size: n * target // total if total else 0 for size, n in histogram.items()}
    left = {size: n - base[size] for size, n in histogram.items()}
    gap = rest = target - sum(size * n for size, n in base.items())
    plan = dict(base)
    for size in sorted(left, reverse=True):
        more = min(left[size], gap // size)
        plan[size], gap = plan[size] + more, gap - more * size
    if gap == 0:
        return plan, True
    if rest * len(left) <= PLAN_BITS:
        more = _nearest(left, rest)
        other = {size: base[size] + more[size] for size in histogram}
        found = target - sum(size * n for size, n in other.items())
        if found == 0:
            return other, True
        plan = other if abs(found) < gap else plan
    if target * len(histogram) > PLAN_BITS:
        return plan, False
    return _nearest(histogram, target), True


def _nearest(histogram: dict[int, int], target: int) -> dict[int, int]:
    """The exact search: sums that can be reached are the bits of a number, size after size.

    Sums above the target are looked at only if it is not hit, and no further above than
    the nearest sum lies below.
    """
    sizes = sorted(histogram, reverse=True)
    reached = _reached(histogram, sizes, target)
    goal = reached[-1].bit_length() - 1
    if goal < target:
        reached = _reached(histogram, sizes, 2 * target - goal - 1)
        over = reached[-1] >> (target + 1)
        if over:
            goal = target + (over & -over).bit_length()
    plan = {}
    for k in range(len(sizes), 0, -1):
        before, size, n = reached[k - 1], sizes[k - 1], 0
        bits = before.to_bytes(before.bit_length() // 8 + 1, "little")
        while goal // 8 >= len(bits) or not bits[goal // 8] >> (goal % 8) & 1:
            n, goal = n + 1, goal - size
        plan[size] = n
    return plan


def _reached(histogram: dict[int, int], sizes: list[int], high: int) -> list[int]:
    """The sums up to ``high`` of the first 0, 1, 2, ... sizes."""
    mask = (1 << (high + 1)) - 1
    reached = [1]
    for size in sizes:
        bits, left, step = reached[-1], min(histogram[size], high // size), 1
        while left:
            take = min(step, left)
            bits |= (bits << (take * size)) & mask
            left, step = left - take, step * 2
        reached.append(bits)
    return reached


def leak_free_split(
    df: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    seed: int = 42,
    eval_share: tuple[int, int] = (3, 10),
    split: str = "split",
) -> DataFrame:
    """Add ``split``: ``eval`` has ``ceil(share * n)`` rows, or as near to that as whole units allow, and
    shares neither a key nor a text with ``train``.

    Units of one size are chosen by their seeded hash, so the split does not depend on
    partitioning or retries. See ``split_units`` for nulls. The input is read several times: store
    it first if it is costly to compute.
    """
    num, den = (int(x) for x in eval_share)
    if not 0 <= num <= den or den < 1:
        raise ValueError("eval_share must be a fraction between 0 and 1")
    members = key_units(df, keys, text).checkpoint()
    units = members.groupBy("unit").agg(F.sum("n").alias("size")).checkpoint()
    histogram = {r["size"]: r["n"] for r in units.groupBy("size").agg(F.count("*").alias("n")).collect()}
    total = sum(size * n for size, n in histogram.items())
    plan, _ = plan_sizes(histogram, -(-num * total // den))
    wanted = df.sparkSession.createDataFrame(list(plan.items()), "size long, _want long")
    sized = units.join(F.broadcast(wanted), "size")
    picked = hash_cutoff(sized, ["unit"], seed, F.col("_want"), "_eval", ["size", "_want"])
    taken = picked.filter("_eval").select("unit")
    # Keys are narrow; of a unit with very many keys adaptive execution splits that side.
    found = members.join(taken.hint("merge"), "unit", "left_semi").select(F.col("key").alias("_key"), F.lit("eval").alias("_side"))
    return _with_units(df.drop(split), keys, found, {split: F.coalesce("_side", F.lit("train"))})
