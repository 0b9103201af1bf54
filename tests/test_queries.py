"""Every registered query against DuckDB, on the given tables and on a hostile copy."""

import shutil
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from helpers import assert_same, duck
from turnloom.workload.oracles import ORACLES
from turnloom.workload.queries import QUERIES
from turnloom.operators import nest

HOT_TURNS = 3000


@pytest.fixture(scope="session")
def hostile_dir(tmp_path_factory):
    """sf0.01 with turn gaps, odd roles, nulls, blanks, markers in contents, and one
    conversation that holds most of the rows."""
    src = Path("/root/testdata/sf0.01")
    if not src.exists():
        pytest.skip("no test data")
    out = tmp_path_factory.mktemp("hostile")
    for name in ("documents", "benchmark"):
        shutil.copy(src / f"{name}.parquet", out)
    duckdb.sql(f"""
      COPY (
        SELECT conv_id,
               turn * (CASE WHEN conv_id % 4 = 1 THEN 3 ELSE 1 END)
                    + (CASE WHEN conv_id % 4 = 2 THEN 2 ELSE 0 END) AS turn,
               CASE WHEN conv_id % 19 = 3 AND turn = 2 THEN NULL
                    WHEN conv_id % 23 = 2 AND turn = 1 THEN 'tool'
                    WHEN conv_id % 6 = 5 AND turn = 2 THEN 'system' ELSE role END AS role,
               CASE WHEN conv_id % 29 = 7 AND turn = 1 THEN NULL
                    WHEN conv_id % 9 = 4 AND turn = 0
                    THEN 'q <|im_start|>user ' || chr(10) || 'mid <|im_end|> tail'
                    WHEN conv_id % 16 = 9 AND turn = 1 THEN '' ELSE text END AS text
        FROM '{src}/conversations.parquet'
        UNION ALL
        SELECT 100003, i, CASE WHEN i % 2 = 0 THEN 'user' WHEN i % 101 = 3 THEN 'system'
                          ELSE 'assistant' END, 'hot ' || (i % 7) || ' é ' || i
        FROM range(0, {HOT_TURNS}) t(i)
        UNION ALL
        SELECT 100004, i, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END,
               'other ' || (i % 5) || chr(160)
        FROM range(0, {HOT_TURNS // 2}) t(i)
        ORDER BY 4
      ) TO '{out}/conversations.parquet' (FORMAT parquet)""")
    assert HOT_TURNS // 2 > nest.MAX_TURNS
    return str(out)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= E.queries().items() and ORACLES.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, name):
    assert assert_same(E.queries()[name](spark, sf_dir), duck(sf_dir), E.oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_hostile_data(spark, hostile_dir, name):
    con = duck(hostile_dir)
    assert assert_same(E.queries()[name](spark, hostile_dir), con, E.oracle_sql()[name]) > 0


GOLDEN_FUNNEL = {
    "0.001": [20, 18, 17, 24, 7],
    "0.01": [100, 90, 84, 155, 82],
    "0.1": [1000, 900, 847, 1327, 585],
}


@pytest.mark.parametrize("sf", GOLDEN_FUNNEL)
def test_golden_counts(spark, sf):
    path = f"/root/testdata/sf{sf}"
    if not Path(path).exists():
        pytest.skip("no test data")
    q = E.queries()
    funnel = {r["stage"]: r["n"] for r in q["stage_funnel"](spark, path).collect()}
    stages = ["conversations", "source_kept", "valid", "candidates", "pairs"]
    assert [funnel[s] for s in stages] == GOLDEN_FUNNEL[sf]


def test_golden_characters(spark, sf_dir):
    want = {
        "sft_chatml_text": 301_057,
        "sft_mistral_text": 288_369,
        "dpo_qwen_text": 299_449,
        "dpo_mistral_text": 289_670,
    }
    got = {n: E.queries()[n](spark, sf_dir).selectExpr("sum(length(text))").first()[0] for n in want}
    assert got == want


def test_golden_details(spark, sf_dir):
    q = E.queries()
    assert q["role_aligned"](spark, sf_dir).filter("aligned").count() == 78
    assert q["pairs_batch_abort"](spark, sf_dir).count() == 53
    split = q["exact_split"](spark, sf_dir).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"eval": 25, "train": 57}


def test_entry(spark):
    assert E.entry(spark).count() == 7
