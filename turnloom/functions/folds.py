"""A left fold over an array that keeps one output per element."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLOCK = 128


def fold_list(
    items: Column,
    state: Column,
    emit: Callable[[Column, Column], Column],
    advance: Callable[[Column, Column], Column],
    out_type: str,
) -> Column:
    """``[emit(s0, x0), emit(s1, x1), ...]`` with ``s(i+1) = advance(s(i), x(i))``.

    Appending to an array copies it, so a plain fold over n elements costs n * n. The
    elements are folded in blocks instead and the block results are flattened once.
    """
    empty = F.array().cast(f"array<{out_type}>")

    def one(acc: Column, x: Column) -> Column:
        return F.struct(
            F.array_append(acc["out"], emit(acc["state"], x)).alias("out"),
            advance(acc["state"], x).alias("state"),
        )

    def block(acc: Column, part: Column) -> Column:
        last = acc["last"]
        start = F.struct(empty.alias("out"), last["state"].alias("state"))
        return F.struct(
            F.array_append(acc["done"], last["out"]).alias("done"),
            F.aggregate(part, start, one).alias("last"),
        )

    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK))).otherwise(
        F.array().cast("array<int>")
    )
    blocks = F.transform(starts, lambda i: F.slice(items, i, F.lit(BLOCK)))
    begin = F.struct(
        F.array().cast(f"array<array<{out_type}>>").alias("done"),
        F.struct(empty.alias("out"), state.alias("state")).alias("last"),
    )
    return F.aggregate(
        blocks, begin, block, lambda a: F.flatten(F.array_append(a["done"], a["last"]["out"]))
    )
