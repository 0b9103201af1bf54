"""Row filters, prefixes, previews and stage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnloom.operators.rank import range_rank

# Up to this many keys are kept in a top-n heap per task; a longer prefix is found by rank
# over range partitions. Both give the same key.
HEAP_LIMIT = 1_000


def drop_null(df: DataFrame, col: str = "text") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def drop_empty(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose string is neither null nor empty."""
    return df.filter(F.length(col) > 0)


def exclude_source(df: DataFrame, source: str, col: str = "source") -> DataFrame:
    """Drop one source; rows without a source stay."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(source)))


def _nth_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """One row: the ``n``-th lowest distinct key, or the highest if there are fewer."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    if n <= HEAP_LIMIT:
        first = keys.orderBy(key).limit(n)
    else:
        first = range_rank(keys, [key]).filter(F.col("rank") < n)
    return first.agg(F.max(key))


def in_prefix(df: DataFrame, key: str, n: int) -> Column:
    """True for rows of the first ``n`` keys in ascending key order.

    The bound is a scalar subquery over the key column alone. Filtering by it reaches
    the Parquet scan, and no row is sorted or shuffled. ``df`` may hold many rows per
    key: apply it to long turns before nesting them.
    """
    if n < 1:
        return F.lit(False)
    return F.coalesce(F.col(key) <= _nth_key(df, key, n).scalar(), F.lit(False))


def take_prefix(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows of the first ``n`` keys; all rows if there are fewer."""
    return df.filter(in_prefix(df, key, n))


def take_penultimate(df: DataFrame, key: str, among: DataFrame | None = None) -> DataFrame:
    """Rows of the second highest key; none if there is only one key. ``among`` may hold the
    keys to choose from."""
    top = (df if among is None else among).select(key).filter(F.col(key).isNotNull()).distinct().orderBy(F.desc(key)).limit(2)
    second = top.agg(F.when(F.count("*") == 2, F.min(key)))
    return df.filter(F.col(key) == second.scalar())


def stage_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """``stage, n`` from one aggregation over ``df``; each value is an aggregate column."""
    one = df.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(k) for k, v in stages.items()])
    cells = [F.struct(F.lit(k).alias("stage"), F.col(k).alias("n")) for k in stages]
    return one.select(F.inline(F.array(*cells)))
