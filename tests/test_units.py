"""Leak-free splits: units against a plain union of sets, plans against all subsets."""

import hashlib
import itertools
import random

import pytest

from turnloom.operators import units as U
from turnloom.operators.splits import overlap_audit

SCHEMA = "key long, text string, more string"


def plain_units(rows):
    """Least md5 of a key that each key reaches over shared texts."""
    root = {k: k for k, _ in rows}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    first = {}
    for k, t in rows:
        if t is not None:
            root[top(k)] = top(first.setdefault(t, k))
    name = {k: hashlib.md5(f":{k}".encode()).hexdigest() for k in root}
    least = {}
    for k in root:
        least[top(k)] = min(least.get(top(k), "g"), name[k])
    return {k: least[top(k)] for k in root}


def graphs():
    rng = random.Random(8)
    chain = [(k, f"t{k + j}") for k in range(16) for j in (0, 1)]
    star = [(k, "same") for k in range(100, 130)] + [(200, f"s{k}") for k in range(20)] + [(k, f"s{k}") for k in range(20)]
    loose = [(rng.randrange(40), rng.choice([None, "", f"x{rng.randrange(60)}"])) for _ in range(40)]
    loose = [(k, t) for k, t in loose if t != "" or k < 9]
    return {"chain": chain, "star": star, "loose": loose, "alone": [(k, None) for k in range(5)] * 2}


@pytest.mark.parametrize("hot", [2, 100_000])
def test_units_equal_a_plain_union(spark, monkeypatch, hot):
    monkeypatch.setattr(U, "HOT_EDGES", hot)
    rows = [(1000 * i + k, t and f"{i}{t}") for i, (_, part) in enumerate(graphs().items()) for k, t in part]
    df = spark.createDataFrame([(k, t, "m") for k, t in rows], SCHEMA).repartition(3)
    want = plain_units(rows)
    got = U.split_units(df, ["key"], "text", "more").collect()
    assert sorted((r["key"], str(r["text"]), r["more"]) for r in got) == sorted((k, str(t), want[k]) for k, t in rows)


def test_rounds_send_no_table_to_the_driver(spark, monkeypatch):
    """Also where Spark would find the tables of a round small enough to broadcast."""
    rows = [(k, t) for part in graphs().values() for k, t in part]
    df = spark.createDataFrame([(k, t, "m") for k, t in rows], SCHEMA).repartition(3)
    plans, plain = [], type(df).checkpoint

    def checkpoint(self, *args):
        done = plain(self, *args)
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return done

    monkeypatch.setattr(type(df), "checkpoint", checkpoint)
    U.key_units(df, ["key"], "text")
    assert sum("SortMergeJoin" in p for p in plans) > 4
    assert not any("Broadcast" in p for p in plans)


def test_plans_are_the_best_possible():
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 3, 5, 6, 10, 25, 40]) + rng.choice([0, 0, 1]) for _ in range(rng.randrange(1, 11))]
        histogram = {s: sizes.count(s) for s in sizes}
        target = rng.randrange(sum(sizes) + 1)
        sums = {sum(c) for k in range(len(sizes) + 1) for c in itertools.combinations(sizes, k)}
        best = min(sums, key=lambda x: (abs(x - target), x))
        plan, proved = U.plan_sizes(histogram, target)
        assert proved and all(0 <= plan[s] <= n for s, n in histogram.items())
        assert abs(sum(s * n for s, n in plan.items()) - target) == abs(best - target)


def test_plans_of_large_tables_are_quick():
    histogram = {1: 7_000_000_000, 2: 900_000_000, 3: 80_000_000, 17: 41, 40_001: 3, 3_000_000_000: 1}
    total = sum(s * n for s, n in histogram.items())
    plan, proved = U.plan_sizes(histogram, total * 3 // 10)
    assert proved and sum(s * n for s, n in plan.items()) == total * 3 // 10
    assert U.plan_sizes({}, 0) == ({}, True) and U.plan_sizes({4: 2}, 5)[0] == {4: 1}
    with pytest.raises(ValueError):
        U.plan_sizes({4: 2}, 9)


def test_split_has_no_leak_and_does_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id div 2 as family", "doc_id", "text")
    one = U.leak_free_split(docs, ["family"]).checkpoint()
    n = docs.count()
    audit = overlap_audit(one, "family").first()
    assert (audit["n_eval"], audit["n_key_overlap"], audit["n_text_overlap"]) == (-(-3 * n // 10), 0, 0)
    other = U.leak_free_split(docs.repartition(13), ["family"])
    assert one.select("doc_id", "split").exceptAll(other.select("doc_id", "split")).isEmpty()
    assert not one.select("split").exceptAll(U.leak_free_split(docs, ["family"], seed=1).select("split")).count()


def test_edges(spark):
    df = spark.createDataFrame([(1, "a", "m"), (1, "a", "m"), (2, None, "m"), (3, "", "m"), (4, "", "n")], SCHEMA)
    rows = U.leak_free_split(df, ["key"], split="more").collect()
    assert len(rows) == 5 and sum(r["more"] == "eval" for r in rows) == 2
    assert U.leak_free_split(df.limit(0), ["key"]).collect() == []
    assert {r["split"] for r in U.leak_free_split(df, ["key"], eval_share=(0, 1)).collect()} == {"train"}
    assert {r["split"] for r in U.leak_free_split(df, ["key"], eval_share=(1, 1)).collect()} == {"eval"}
    with pytest.raises(ValueError, match="_key"):
        U.leak_free_split(df.withColumnRenamed("more", "_key"), ["key"])
    with pytest.raises(ValueError, match="fraction"):
        U.leak_free_split(df, ["key"], eval_share=(3, 2))
    with pytest.raises(Exception, match="null key"):
        U.leak_free_split(df.selectExpr("nullif(key, 1) key", "text"), ["key"]).collect()
