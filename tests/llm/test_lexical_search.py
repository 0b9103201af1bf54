"""Ranked search against SQL and plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from edges import SCHEMA, edge_docs
from helpers import assert_same, duck
from turnloom.llm import lexical_search as X
from turnloom.llm.common import table

LOWER = {c: c + 32 for c in range(65, 91)}
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=50):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in asked.items():
        found = []
        for d, b in bags:
            m = 50 + (50 * sum(b.values()) * n) // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m))
                for t in ts
                if t in b
            )
            if s > 0:
                found.append((-s, X.NO_ID if d is None else d))
        for r, (s, d) in enumerate(sorted(found)[:k]):
            out.append((i, r + 1, None if d == X.NO_ID else d, -s))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_against_sql(spark, sf_dir):
    got = X.op13_stratified_search(spark, sf_dir)
    assert assert_same(got, duck(sf_dir), X.OP13_SQL) > 500


ITEMS = [(1, "The Zug1 und. a1"), (2, None), (3, "!!"), (4, "nowhere-else"), (4, "x ONE é"), (None, "the1 the2 b")]


@pytest.mark.parametrize("limit,group", [(X.BLOCK_BYTES, X.ITEMS), (300, 2)])
def test_edge_rows(spark, monkeypatch, limit, group):
    """Also with blocks of few documents, and with items in several groups."""
    monkeypatch.setattr(X, "ITEMS", group)
    docs = edge_docs(spark, more=["the " * 700 + "x", "b b", "B", "b", "Zug1,zug1-ZUG1"])
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    index = X.build_index(docs.repartition(3), limit)
    assert rows_of(X.search(index, items)) == plain(pairs, ITEMS)
    assert rows_of(X.search(index, items, 3)) == plain(pairs, ITEMS, 3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert X.search(X.build_index(none), items).collect() == []
    assert X.search(X.build_index(edge_docs(spark)), items.limit(0)).collect() == []


def test_a_block_is_one_stratum_with_postings_by_frequency(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    index = X.build_index(docs)
    seen = 0
    by_id = {r["doc_id"]: Counter(terms(r["text"])) for r in docs.select("doc_id", "text").collect()}
    batch = index.blocks.limit(40).toArrow().combine_chunks().to_batches()[0]
    for row in range(batch.num_rows):
        block = X.Block(batch, row)
        ids, rows, tf = block.postings()
        for d in ids.tolist():
            assert 50 + (50 * sum(by_id[d].values()) * index.n_docs) // index.n_terms == block.m
        for a, b, top in zip(block.at[:-1], block.at[1:], block.top):
            assert tf[a] == top and np.all(np.diff(tf[a:b]) <= 0)
        assert len(tf) == sum(len(by_id[d]) for d in ids.tolist())
        seen += len(ids)
    assert seen


def test_long_integers_where_doubles_are_not_exact(spark, monkeypatch):
    monkeypatch.setattr(X, "EXACT", 1.0)
    docs = edge_docs(spark)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    asked = X.Queries([1], np.ones(1, np.uint64), np.ones((1, 1), bool))
    asked.weigh(np.ones(1), 5)
    assert asked.kind is np.int64
    assert rows_of(X.search(X.build_index(docs), items)) == plain(pairs, ITEMS)
