"""Substring dedup, decontamination and the Jaccard join against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from edges import SCHEMA, edge_docs, texts_of, words
from turnloom.llm import decontaminate as D, jaccard_join as J, substring_dedup as S
from turnloom.llm.common import table

LOWER = {c: c + 32 for c in range(65, 91)}


def kept_words(rows, window):
    """doc_id -> (words, removed, kept text), by the definition."""
    first, out = {}, {}
    for doc_id, text in sorted({r for r in rows if r[0] is not None}, key=lambda r: r[0]):
        w = (text or "").encode().split()
        hit, new = [False] * len(w), []
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in first:
                hit[k : k + window] = [True] * window
            else:
                new.append(key)
        first.update(dict.fromkeys(new, doc_id))
        out[doc_id] = (len(w), sum(hit), b" ".join(x for x, h in zip(w, hit) if not h).decode())
    return out


@pytest.mark.parametrize("window", [50, 5])
def test_substring_dedup_edges(spark, window):
    docs = edge_docs(spark)
    got = S.dedup(docs, window).collect()
    assert len(got) == docs.count() and "score" in got[0]
    want = kept_words(texts_of(docs), window)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert (r["n_words"], r["n_removed"], r["kept_text"]) == want[r["doc_id"]]


def test_substring_dedup_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_SHARE", 0.0)  # every counted anchor is hot
    rng = random.Random(1)
    passages = [words(rng, 70) for _ in range(3)]
    rows = [(i, f"{words(rng, rng.randrange(60))} {rng.choice(passages)[: rng.randrange(50, 999)]} {words(rng, 30)} {rng.choice(passages)}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = kept_words(rows, 50)
    for r in S.dedup(docs).collect():
        assert (r["n_words"], r["n_removed"], r["kept_text"]) == want[r["doc_id"]]


def test_factors_point_at_equal_words(spark):
    docs = edge_docs(spark)
    text = dict(texts_of(docs.filter("doc_id is not null")))
    for r in S.dedup(docs).collect():
        for f in r["factors"]:
            a, b = text[r["doc_id"]].split(), text[f["ref_doc"]].split()
            assert f["ref_doc"] < r["doc_id"]
            assert a[f["start"] : f["start"] + f["n"]] == b[f["ref_start"] : f["ref_start"] + f["n"]]


def test_op1_is_exact_on_documents(spark, sf_dir):
    want = kept_words(texts_of(table(spark, sf_dir, "documents")), 50)
    got = S.op1_lempel_ziv(spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        n, removed, kept = want[r["doc_id"]]
        digest = hashlib.sha256(kept.encode()).hexdigest()
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, removed, digest)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    assert S.dedup(none).collect() == []
    assert J.link_documents(none).collect() == []
    assert J.keep_one(none).collect() == []
    assert D.find_hits(none, items).collect() == []
    assert D.find_hits(edge_docs(spark), items).filter("n_hit > 0").count() == 0


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits(text, items, window=10):
    low = lambda t: WORD.findall((t or "").translate(LOWER).encode())
    w, hit, found = low(text), set(), set()
    for item, t in items:
        x = low(t)
        size = min(window, len(x))
        for k in range(len(x) - size + 1 if x else 0):
            for at in range(len(w) - size + 1):
                if w[at : at + size] == x[k : k + size]:
                    hit |= set(range(at, at + size))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, n)) for i, n in enumerate((30, 12, 10, 9, 4, 1))]
    rows += [(6, None), (7, ""), (8, rows[0][1]), (9, rows[0][1][40:]), (9, rows[1][1]), (10, "a b a b a b a b a b a b")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [1_000_000, 15])
def test_hits(spark, items, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_WORDS", block)
    rng = random.Random(4)
    known = [r["text"] or "" for r in items.collect()]
    mixed = [" ".join(rng.choice([words(rng, 5), t, t[rng.randrange(40) :], t.upper()]) for t in known) for _ in range(12)]
    docs = edge_docs(spark, [*mixed, "a b " * 30])
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    for r in D.find_hits(docs, items).collect():
        assert (r["n_words"], r["n_hit"], r["hit_items"]) == hits(r["text"], rows)


def test_decontaminate_cuts_spans(spark, items):
    known = items.filter("item_id = 0").first()["text"]
    docs = edge_docs(spark, [f"Before that {words(random.Random(9), 60)}; {known}! And é after.", known])
    out = {r["doc_id"]: r for r in D.decontaminate(docs, items).collect()}
    assert docs.columns == D.decontaminate(docs, items).columns
    assert known not in out[11]["text"] and out[11]["text"].endswith("And é after.")
    assert out[11]["n_chars"] == len(out[11]["text"]) and 12 not in out
    assert out[5]["text"] == docs.filter("doc_id = 5").first()["text"] and out[0]["text"] is None


def test_op7_on_documents(spark, sf_dir):
    rows = [(r[0], r[1]) for r in texts_of(table(spark, sf_dir, "benchmark"), "item_id")]
    docs = dict(texts_of(table(spark, sf_dir, "documents")))
    got = {r["doc_id"]: r for r in D.op7_suffix_automaton(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    some = [d for d, r in got.items() if r["contaminated"]][:10] + sorted(docs)[:20]
    for d in some:
        n, hit, found = hits(docs[d], rows)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        r = got[d]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(found), digest)


def linked(rows):
    """doc_id -> (set size, component), by comparing all pairs."""
    sets = {}
    for d, t in rows:
        w = (t or "").translate(LOWER).encode().split()
        sets[d] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    comp = {d: d for d in sets}
    find = lambda d: d if comp[d] == d else find(comp[d])
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    comp[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_copies(seed, n):
    """Chains and stars of near copies at all distances, short texts, and shared passages."""
    rng = random.Random(seed)
    bases = [words(rng, size).split() for size in (3, 8, 20, 60, 60, 150)]
    shared = words(rng, 40)
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(3)] = [f"new{rng.randrange(9)}"] * rng.randrange(3)
        rows.append((i, " ".join(w) + (" " + shared if rng.random() < 0.2 else "")))
        if rng.random() < 0.3:
            bases.append(w or ["z"])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rows = near_copies(seed, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.link_documents(docs).collect()}
    assert got == linked(rows)


def test_link_edges(spark):
    docs = edge_docs(spark)
    named = [r for r in set(texts_of(docs)) if r[0] is not None]
    want = linked(named)
    got = J.link_documents(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["n_shingles"] > 0
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    kept = [r["doc_id"] for r in J.keep_one(docs).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({c for _, c in want.values()})
    assert kept.count(None) == 1


def test_op9_on_documents(spark, sf_dir):
    rows = [r for r in texts_of(table(spark, sf_dir, "documents")) if r[0] < 400]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.link_documents(docs).collect()}
    assert got == linked(rows)


@pytest.mark.parametrize("groups", [1, 7, 5000])
def test_one_bucket_counts_alike_for_any_number_of_groups(groups):
    """Each document comes out once, in one group, whatever the number of groups."""
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(6):
        docs = rng.choice(900, 40, replace=False).astype(np.int64)
        counts = rng.integers(1, 6, 40).astype(np.uint32)
        shingles = rng.integers(0, 300, int(counts.sum())).astype(np.uint32)
        info = np.stack([docs, *(docs + k for k in range(4))])
        rows.append((docs.tobytes(), counts.tobytes(), shingles.tobytes(), b"", info.tobytes()))
    names = ["docs", "counts", "shingles", "marks", "info"]
    table = pa.table({c: pa.array([r[k] for r in rows], pa.binary()) for k, c in enumerate(names)})
    got = J.count_shared(groups)(table)
    assert got.num_rows <= min(groups, 480)
    found = {}
    for part, docs, m in zip(*(got.column(c).to_pylist() for c in ("part", "docs", "m"))):
        for d, n in zip(np.frombuffer(docs, np.int64).tolist(), np.frombuffer(m, np.int64).tolist()):
            assert d not in found
            found[d] = n
    of = [d for r in rows for d, n in zip(np.frombuffer(r[0], np.int64), np.frombuffer(r[1], np.uint32)) for _ in range(n)]
    every = np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows]).tolist()
    often = {s for s in every if every.count(s) > 1}
    want = {}
    for d, s in zip(of, every):
        if s in often:
            want[int(d)] = want.get(int(d), 0) + 1
    assert found == want
    told = np.concatenate([np.frombuffer(x, np.int64).reshape(5, -1)[0] for x in got.column("info").to_pylist()])
    assert sorted(told.tolist()) == sorted(x for r in rows for x in np.frombuffer(r[0], np.int64).tolist())
