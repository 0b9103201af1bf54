"""Plans that must stay as they are at scale."""

import re

import pytest

import __spark_entry__ as E
from turnloom.operators import nest, rank
from turnloom.operators.nest import nest_preferences
from turnloom.operators.select import take_prefix
from turnloom.operators.splits import balanced_sample, exact_split
from turnloom.workload import views
from turnloom.workload.queries import QUERIES


@pytest.fixture
def static_plans(spark):
    """Plans without runtime conversions: what a query asks for on large tables."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k, v in old.items():
        spark.conf.set(k, v)


def main_part(plan):
    """The plan without its subqueries."""
    return "\n".join(line for line in plan.splitlines() if not re.match(r"^[ :]*:  ?", line))


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join_no_python(spark, sf_dir, static_plans, name):
    plan = static_plans(E.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["sft_chatml_text", "sft_mistral_text", "length_budget"])
def test_texts_take_one_shuffle(spark, sf_dir, static_plans, name):
    assert static_plans(E.queries()[name](spark, sf_dir)).count("Exchange") == 1


@pytest.mark.parametrize("name", ["role_normalize", "prompt_grid"])
def test_row_operators_take_none(spark, sf_dir, static_plans, name):
    assert "Exchange" not in static_plans(E.queries()[name](spark, sf_dir))


def test_split_does_not_move_the_rows(spark, sf_dir, static_plans):
    docs = views.documents(spark, sf_dir)
    assert "Exchange" not in main_part(static_plans(exact_split(docs, ["doc_id"])))


def test_prefix_reaches_the_scan(spark, sf_dir):
    plan = take_prefix(views.turns(spark, sf_dir), "conv_id", 10)
    text = plan._jdf.queryExecution().toString()
    assert re.search(r"DataFilters: \[[^\]]*conv_id#\d+L <= ", text)


def test_samples_do_not_sort_rows(spark, sf_dir, static_plans):
    """Complete rows are compared with a cut per stratum; only keys are ordered."""
    docs = views.documents(spark, sf_dir).select("doc_id", "lang", "text")
    plan = static_plans(balanced_sample(docs, "lang", ["doc_id"], 20))
    assert not re.search(r"Window.*text#", plan)


def test_long_prefix_gathers_no_keys(spark, sf_dir, static_plans):
    plan = static_plans(take_prefix(views.turns(spark, sf_dir), "conv_id", 100_000))
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan


def test_many_long_conversations_are_spread(spark, sf_dir, static_plans, monkeypatch):
    """Too many to broadcast: texts are never hashed on the bare key, except to gather the
    short conversations and the parts."""
    monkeypatch.setattr(rank, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(nest, "BROADCAST_ROWS", 0)
    turns = views.preference_turns(spark, sf_dir)
    nested = nest_preferences(turns, max_turns=2, probe=views.turns(spark, sf_dir))
    plan = static_plans(nested.parts)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\), ENSURE", plan)
    joined = [k for k in keys if re.match(r"conv_id#\d+L, \d+$", k)]
    assert any("_salt" in k for k in keys)
    for block in re.split(r"\n", plan):
        if "SortMergeJoin" in block:
            assert "_salt" in block or "_part" in block or "turn" in block or "side" not in block
    assert len(joined) <= 4  # counts and keys of the view


def test_validity_reads_no_texts(spark, sf_dir, static_plans):
    plan = static_plans(E.queries()["pair_validity"](spark, sf_dir))
    assert "text" not in " ".join(re.findall(r"ReadSchema: \S+", plan))
