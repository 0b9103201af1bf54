"""The whole pipeline on a small fixture: every stage against brute force on its own input."""

import math
import random
import re
from collections import Counter

import pytest

import corpus_pipeline as P
from test_models import plain_score
from test_native import plan
from test_pipeline import least_of_components
from turnloom.llm import toxicity as X
from turnloom.llm.common import stored

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = [name for name, _ in P.STAGES]


def sentence(rng, n):
    return " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(60)) for _ in range(n))


def tables():
    """Toxic, near-equal, leaked and clean texts; nulls, empty texts and repeated rows."""
    rng = random.Random(11)
    items = [(k, sentence(rng, 14)) for k in range(4)] + [(9, "short item"), (10, None)]
    rows, labels = [], []
    for d in range(260):
        words = sentence(rng, rng.randrange(15, 70)).split()
        if d % 5 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten"]))
        labels.append((d, int(d % 5 == 0)))
        if d % 20 == 3:
            words[5:5] = items[d % 4][1].upper().split()
        rows.append([d, " ".join(words)])
    for d in range(260, 290):  # near copies: one word of many differs
        words = rows[(d - 260) * 5 + 1][1].split()
        words[-1] += "x"
        rows.append([d, " ".join(words)])
    rows += [[300, None], [301, ""], [302, items[0][1]], [303, items[1][1] + " x y"], [None, sentence(rng, 30)]]
    docs = [(d, t, "en", None if i % 7 == 0 else f"s{i % 3}", None if t is None else len(t)) for i, (d, t) in enumerate(rows)]
    return [*docs, docs[7], docs[7]], labels, items


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """The folder, and the rows before the first stage and after each."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs, labels, items = tables()
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    found.append(now)
    for name, stage in P.STAGES:
        now = stored(stage(spark, now, folder), name)
        found.append(now)
    return folder, found


def rows(df):
    return sorted((tuple(r[c] for c in SCHEMA.replace(" string", "").replace(" long", "").split(", ")) for r in df.collect()), key=repr)


def test_all_but_the_last_keep_the_columns(chain):
    before, *after, last = chain[1]
    assert all(df.columns == before.columns for df in after) and set(before.columns) < set(last.columns)


def test_toxic_documents_go(spark, chain):
    folder, found = chain
    net = X.fit(found[0], spark.read.parquet(f"{folder}/labels.parquet"))
    want = [r for r in rows(found[0]) if (plain_score(net, r[1]) if r[1] else 0) < 0.5]
    assert rows(found[1]) == want
    gone = {r[0] for r in rows(found[0])} - {r[0] for r in want}
    toxic = {d for d in range(260) if d % 5 == 0}
    assert len(gone & toxic) > 45 and len(gone - toxic) <= 5


def test_one_of_near_copies_stays(chain):
    before, after = rows(chain[1][1]), rows(chain[1][2])
    named = {r[0]: r for r in before if r[0] is not None}
    want = [named[d] for d in least_of_components([(d, r[1]) for d, r in named.items()])]
    want += [r for r in before if r[0] is None]
    assert after == sorted(want, key=repr) and len(after) < len(before) - 15


def test_benchmark_passages_are_cut(spark, chain):
    folder, found = chain
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        ws = ALNUM.findall((r["text"] or "").translate(LOWER))
        windows |= {tuple(ws[k : k + 10]) for k in range(max(1, len(ws) - 9))} if ws else set()
    want = []
    for r in rows(found[2]):
        ws = ALNUM.findall((r[1] or "").translate(LOWER))
        hit = {k + j for w in windows for k in range(len(ws) - len(w) + 1) if tuple(ws[k : k + len(w)]) == w for j in range(len(w))}
        if len(hit) * 2 <= len(ws):
            want.append((r[0], [w for k, w in enumerate(ws) if k not in hit], bool(hit)))
    got = [(r[0], ALNUM.findall((r[1] or "").translate(LOWER)), r) for r in rows(found[3])]
    assert sorted((d, ws) for d, ws, _ in got if d is not None) == sorted((d, ws) for d, ws, _ in want if d is not None)
    assert sum(h for _, _, h in want) >= 8 and not {302, 303} & {d for d, _, _ in got}
    cut = {d for d, _, h in want if h}
    assert all(r[4] == len(r[1]) for d, _, r in got if d in cut)


def test_sources_are_mixed_to_their_targets(chain):
    before, after = rows(chain[1][3]), rows(chain[1][4])
    size = lambda r: len((r[1] or "").split())
    taken = Counter(after)
    assert set(taken) <= set(before) and max(taken.values()) <= 2
    sources = sorted({r[3] for r in before if r[3] is not None})
    names = [*sources, None]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    sizes = {s: sum(size(r) for r in before if r[3] == s) for s in names}
    targets = plan(sizes, weights, 1.5, 2)
    for s in names:
        got = sum(size(r) * n for r, n in taken.items() if r[3] == s)
        assert abs(got - targets[s]) <= 2 * max(size(r) for r in before if r[3] == s)


def test_shards_have_equal_counts(spark, chain):
    folder, found = chain
    assert rows(found[5]) == rows(found[4])
    placed = [(r["shard"], r["slot"]) for r in found[5].collect()]
    counts = Counter(s for s, _ in placed)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(k for t, k in placed if t == s) == list(range(n))
    assert math.isclose(sum(counts.values()), found[4].count())


def test_run_gives_the_rows_of_the_chain(spark, chain):
    folder, found = chain
    assert rows(P.run(spark, folder)) == rows(found[5])


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
