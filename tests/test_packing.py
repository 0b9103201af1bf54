"""Packing against a row-at-a-time best-fit-decreasing walk."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from turnloom.operators.packing import least_bins, pack_sequences, plan_bins


def walk(lengths, budget):
    """Fill of each bin, placing one row at a time, fullest fitting bin first."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [k for k, f in enumerate(bins) if f + n <= budget]
        if fit:
            bins[max(fit, key=lambda k: bins[k])] += n
        else:
            bins.append(n)
    return bins


CASES = [
    (10, [10, 9, 1, 5, 5, 5, 3, 3, 3, 3, 2]),
    (1, [1, 1, 1]),
    (7, [4] * 5 + [3] * 9),
    (100, [random.Random(1).randrange(1, 101) for _ in range(700)]),
    (64, [random.Random(2).choice([33, 32, 31, 21, 11, 5, 1]) for _ in range(900)]),
    (1024, [random.Random(3).randrange(1, 300) for _ in range(500)]),
]


@pytest.mark.parametrize("budget,lengths", CASES)
def test_plan_equals_the_walk(budget, lengths):
    segments, n_bins = plan_bins(Counter(lengths).items(), budget)
    fills, placed = Counter(), Counter()
    for length, low, high, first, each, start in segments:
        assert low == placed[length]
        placed[length] = high
        for r in range(high - low):
            place = start + r % each * length
            assert fills[first + r // each] == place
            fills[first + r // each] += length
    want = walk(lengths, budget)
    assert placed == Counter(lengths) and sorted(fills.values()) == sorted(want) and n_bins == len(want)
    assert n_bins <= 11 / 9 * least_bins(Counter(lengths).items(), budget) + 1
    assert least_bins(Counter(lengths).items(), budget) <= n_bins


def test_plan_does_not_grow_with_rows():
    rng = random.Random(4)
    some = [(n, rng.randrange(1, 9)) for n in range(1, 1025)]
    few, _ = plan_bins(some, 1024)
    many, bins = plan_bins([(n, c * 1_000_000_007) for n, c in some], 1024)
    assert bins > 1_000_000 and len(many) <= 3 * 1024 * 10 and len(few) <= 3 * 1024 * 10


def test_rows_find_their_bins(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([7, 7, 7, 40, 64, 99, 100, 1])) for k in range(2000)] + [(2000, None), (2001, 0), (2002, 500)]
    df = spark.createDataFrame(rows, "k long, n long").repartition(7)
    got = pack_sequences(df, ["k"], "n", 100).collect()
    assert len(got) == len(rows) and {r["k"] for r in got} == {k for k, _ in rows}
    bins = {}
    for r in got:
        if r["n"] is None or r["n"] < 1:
            assert r["bin"] is None and r["start_pos"] is None
        else:
            bins.setdefault(r["bin"], []).append((r["start_pos"], min(r["n"], 100)))
    for spans in bins.values():
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
        assert at <= 100
    lengths = [min(n, 100) for _, n in rows if n]
    assert len(bins) == len(walk(lengths, 100))
    again = pack_sequences(df.repartition(3), ["k"], "n", 100).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_empty_and_bad_arguments(spark):
    none = spark.createDataFrame([], "k long, n long")
    assert pack_sequences(none, ["k"], "n", 8).collect() == []
    with pytest.raises(ValueError):
        pack_sequences(none, ["k"], "n", 0)


def test_texts_are_not_collected(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 9 + 1).alias("n"))
    plan = pack_sequences(df, ["k"], "n", 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan
