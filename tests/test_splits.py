import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from turnloom.operators import select as sel
from turnloom.operators import splits
from turnloom.operators.metrics import preference_metrics
from turnloom.operators.rank import hash_rank, order_hash, range_rank
from turnloom.operators.shaping import length_budget, step_plan


def md5(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


@pytest.fixture(scope="module")
def keyed(spark):
    """1,000 rows; one group holds a third of them."""
    group = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)
    df = spark.range(1000).select((F.col("id") * 37 % 1009).alias("k"), group.alias("g"))
    return df.repartition(7).cache()


def test_range_rank(spark, keyed):
    got = rows_of(range_rank(keyed, ["g", "k"]), "rank", "g", "k")
    want = sorted((r["g"], r["k"]) for r in keyed.collect())
    assert sorted(got) == [(i, *gk) for i, gk in enumerate(want)]


@pytest.mark.parametrize(
    "n, num, den", [(1000, 3, 10), (1, 3, 10), (7, 1, 3), (10, 1, 1), (9, 0, 5), (0, 3, 10)]
)
def test_exact_split_sizes(spark, n, num, den):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = splits.exact_split(df, ["k"], eval_share=(num, den)).collect()
    assert sorted(r["k"] for r in got) == list(range(n))
    assert sum(r["split"] == "eval" for r in got) == math.ceil(n * num / den)


def test_exact_split_is_lowest_hashes_under_any_partitioning(spark, keyed):
    keys = sorted((r["k"] for r in keyed.collect()), key=lambda k: md5(42, k))
    want = set(keys[:300])
    for parts in (1, 3, 50):
        got = splits.exact_split(keyed.repartition(parts), ["k"]).filter("split = 'eval'")
        assert {r["k"] for r in got.collect()} == want


def test_null_keys_are_refused(spark):
    df = spark.createDataFrame([(1,), (None,)], "k long")
    with pytest.raises(Exception, match="null key k"):
        splits.exact_split(df, ["k"]).collect()


def test_share_must_be_a_fraction(keyed):
    with pytest.raises(ValueError):
        splits.exact_split(keyed, ["k"], eval_share=(4, 3))


def test_hash_rank(spark, keyed):
    hashed = keyed.withColumn("h", order_hash(["k"], 1))
    want = {k: i for i, k in enumerate(sorted((r["k"] for r in keyed.collect()), key=lambda k: md5(1, k)))}
    assert {r["k"]: r["rank"] for r in hash_rank(hashed, "h", ["k"]).collect()} == want
    for few in (False, True):
        low = hash_rank(hashed, "h", ["k"], below=20, few_groups=few).collect()
        assert {r["k"]: r["rank"] for r in low} == {k: i for k, i in want.items() if i < 20}


@pytest.mark.parametrize("k", [1, 5, 100, 333, 2000])
def test_balanced_sample(spark, keyed, k):
    data = keyed.unionByName(spark.createDataFrame([(5000, None), (5001, None)], keyed.schema))
    by_group = {}
    for r in data.collect():
        by_group.setdefault(r["g"], []).append(r["k"])
    want = sorted(
        ((x, g) for g, ks in by_group.items() for x in sorted(ks, key=lambda v: md5(9, v))[:k]),
        key=repr,
    )
    assert rows_of(splits.balanced_sample(data, "g", ["k"], k, seed=9), "k", "g") == want
    wide = splits.balanced_sample(data.withColumn("x", F.lit("text")), "g", ["k"], k, seed=9)
    assert rows_of(wide, "k", "g") == want and wide.columns == [*data.columns, "x"]


@pytest.mark.parametrize("k", [999, 1000, 1001, 1003])
def test_balanced_sample_takes_equal_keys_together(spark, k):
    df = spark.range(4000).select((F.col("id") % 2000).alias("k"), F.lit(1).alias("g"))
    got = splits.balanced_sample(df, "g", ["k"], k)
    assert got.count() == 2 * k and got.distinct().count() == k


def test_exact_split_refuses_equal_keys_across_the_cut(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 6 + [2] * 5], "k long")
    with pytest.raises(Exception, match="repeat across the cut"):
        splits.exact_split(df, ["k"]).collect()


def test_prefix(spark, keyed, monkeypatch):
    ids = sorted(r["k"] for r in keyed.collect())
    doubled = keyed.unionByName(keyed)
    for limit in (0, 10_000):
        monkeypatch.setattr(sel, "HEAP_LIMIT", limit)
        got = sorted(r["k"] for r in sel.take_prefix(doubled, "k", 17).collect())
        assert got == sorted(ids[:17] * 2)
        assert sel.take_prefix(keyed, "k", 5000).count() == 1000
    assert sel.take_prefix(keyed, "k", 0).count() == 0


def test_prefix_split_modes(spark, keyed):
    ids = sorted(r["k"] for r in keyed.collect())
    for mode, n_train in (("overlap", 1000), ("disjoint", 983)):
        got = splits.prefix_split(keyed, "k", 17, mode).collect()
        assert sorted(r["k"] for r in got if r["split"] == "eval") == ids[:17]
        assert sum(r["split"] == "train" for r in got) == n_train
    with pytest.raises(ValueError):
        splits.prefix_split(keyed, "k", 17, "other")


def test_penultimate(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (3, "d"), (2, "e")], "k long, x string")
    assert rows_of(sel.take_penultimate(df, "k"), "x") == [("b",), ("e",)]
    assert sel.take_penultimate(df.filter("k = 1"), "k").count() == 0


def test_overlap_audit(spark):
    rows = [
        (1, "same", "train"),
        (2, "same", "train"),
        (3, "own", "train"),
        (1, "same", "eval"),
        (8, "same", "eval"),
        (9, "new", "eval"),
        (9, None, "eval"),
        (4, None, "train"),
    ]
    got = splits.overlap_audit(spark.createDataFrame(rows, "k long, text string, split string"), "k")
    assert tuple(got.first()) == (4, 1, 2)
    empty = splits.overlap_audit(spark.createDataFrame([], "k long, text string, split string"), "k")
    assert tuple(empty.first()) == (0, 0, 0)


@pytest.mark.parametrize("n", [1, 7, 50, 1000])
def test_step_plan(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k").repartition(3)
    got = step_plan(df, ["k"], seed=5, batch_size=2, accumulation=3, max_steps=20)
    order = [
        k
        for e in range(math.ceil(120 / n))
        for k in sorted(range(n), key=lambda k: md5(5, e, k))
    ][:120]
    want = sorted((k, i // 6, i % 6) for i, k in enumerate(order))
    assert sorted(rows_of(got, "k", "step", "slot")) == want


def test_step_plan_of_nothing(spark):
    df = spark.range(0).withColumnRenamed("id", "k")
    assert step_plan(df, ["k"], 5, 2, 3, 20).count() == 0
    with pytest.raises(ValueError):
        step_plan(df, ["k"], 5, 0, 3, 20)


def test_length_budget(spark):
    df = spark.createDataFrame([(1, "a b c ", 9), (2, "a b", 1), (3, "", 0)], "k long, text string, n long")
    got = rows_of(length_budget(df, 2), "k", "n_tokens", "over_budget", "cut_text")
    assert got == [(1, 3, True, "a b"), (2, 2, False, "a b"), (3, 0, False, "")]
    got = rows_of(length_budget(df, 2, token_count_col="n"), "k", "n_tokens", "over_budget", "cut_text")
    assert got == [(1, 9, True, "a b"), (2, 1, False, "a b"), (3, 0, False, "")]


def test_stage_counts(spark):
    stages = {"all": F.count("*"), "big": F.count_if(F.col("id") > 6), "none": F.sum(F.lit(None).cast("int"))}
    assert rows_of(sel.stage_counts(spark.range(10), stages), "stage", "n") == [
        ("all", 10),
        ("big", 3),
        ("none", 0),
    ]


def test_preference_metrics(spark):
    rng = random.Random(1)
    rows = [("x", *[rng.uniform(-900, 0) for _ in range(4)]) for _ in range(50)]
    rows += [("y", -1e5, 0.0, 0.0, -1e5), ("y", 0.0, -1e5, -1e5, 0.0)]
    cols = "g string, policy_chosen double, ref_chosen double, policy_rejected double, ref_rejected double"
    got = {r["g"]: r for r in preference_metrics(spark.createDataFrame(rows, cols), ["g"], 0.2).collect()}
    ms = [0.2 * ((a - b) - (c - d)) for g, a, b, c, d in rows if g == "x"]
    assert got["x"]["n"] == 50
    assert got["x"]["accuracy"] == pytest.approx(sum(m > 0 for m in ms) / 50)
    assert got["x"]["mean_margin"] == pytest.approx(sum(ms) / 50)
    loss = sum(max(-m, 0) + math.log1p(math.exp(-abs(m))) for m in ms) / 50
    assert got["x"]["mean_loss"] == pytest.approx(loss)
    assert got["y"]["mean_loss"] == pytest.approx(20000)
