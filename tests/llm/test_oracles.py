"""Queries with SQL counterparts against DuckDB."""

import pytest

from helpers import assert_same, duck
from turnloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op1_lempel_ziv", "op7_suffix_automaton", "op9_grouped_prefix"])
def test_against_sql(spark, sf_dir, name):
    assert assert_same(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) == 1000
