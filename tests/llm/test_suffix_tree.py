"""The probabilistic suffix tree against plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from edges import SCHEMA, edge_docs
from turnloom.llm import suffix_tree as S

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    text = (text or "").translate(LOWER)
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w] + [None]


def plain(rows, by=S.Settings()):
    """(held_out, n_tokens, n_known, N, base, score, context words) of each (doc_id, text)."""
    docs = [(zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2, tokens(t)) for d, t in rows]
    grams = [Counter() for _ in range(by.max_depth + 2)]
    for held, ws in docs:
        if not held:
            for i in range(len(ws)):
                for k in range(min(i, by.max_depth) + 1):
                    grams[k + 1][tuple(ws[i - k : i + 1])] += 1
    n, v = sum(grams[1].values()), len(grams[1])
    nexts = {}
    for k in range(2, by.max_depth + 2):
        for g, c in grams[k].items():
            nexts.setdefault(g[:-1], {})[g[-1]] = c
    count = {s: sum(x.values()) for s, x in nexts.items()}
    least = max(by.min_count, by.min_share * n)
    kept = set()

    def p(state, w):
        while state and state not in kept:
            state = state[1:]
        if not state:
            return (grams[1][(w,)] + 1) / (n + v + 1), 0
        below = p(state[1:], w)[0]
        return (nexts[state].get(w, 0) + by.a * below) / (count[state] + by.a), len(state)

    for s in sorted(nexts, key=len):
        if count[s] >= least:
            told = 0.0
            for w, c in nexts[s].items():
                log_p = float(np.float16(-math.log2(p(s[1:], w)[0]))) * -math.log(2)
                told += c * (math.log(c - 1 + by.a * math.exp(log_p)) - log_p)
            if told - count[s] * math.log(count[s] - 1 + by.a) >= by.gain * count[s]:
                kept.add(s)
    out = []
    for held, ws in docs:
        found = [p(tuple(ws[max(0, i - by.max_depth) : i]), w) for i, w in enumerate(ws)]
        base = sum(math.log10((grams[1][(w,)] + 1) / (n + v + 1)) for w in ws)
        known = sum(grams[1][(w,)] > 0 for w in ws)
        out.append(
            (held, len(ws), known, n, base, sum(math.log10(x) for x, _ in found), sum(d for _, d in found))
        )
    return out, kept


def corpus(seed, n):
    """Texts of a small grammar, so that contexts of several lengths tell something."""
    rng = random.Random(seed)
    follow = {a: [rng.choice("abcdefgh") for _ in range(2)] for a in "abcdefgh"}
    deep = {(a, b): rng.choice("abcdefgh") for a in "abcdefgh" for b in "abcdefgh"}
    rows = []
    for d in range(n):
        ws = [rng.choice("abcdefgh")]
        for _ in range(rng.randrange(60)):
            r, last = rng.random(), tuple(ws[-2:])
            if r < 0.4 and last in deep:
                ws.append(deep[last])
            elif r < 0.9 and ws[-1] in follow:
                ws.append(rng.choice(follow[ws[-1]]))
            else:
                ws.append(rng.choice(["Ä", "x1", "zz", "a"]) + rng.choice(["", str(rng.randrange(9))]))
        shown = [w.upper() if w.isascii() and rng.random() < 0.2 else w for w in ws]
        rows.append((d, rng.choice([" ", "\t", "  \n"]).join(shown)))
    return rows


def compare(got, rows, by=S.Settings()):
    want, kept = plain(rows, by)
    key = lambda r: tuple("" if x is None else str(round(x, 6)) if isinstance(x, float) else str(x) for x in r)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "context_words"]
    got = sorted(([r[c] for c in names] for r in got), key=key)
    want = sorted(([d, *x] for (d, _), x in zip(rows, want)), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[7] == b[7]
        assert a[5:7] == pytest.approx(b[5:7], rel=1e-9, abs=1e-9)
    return kept


@pytest.mark.parametrize(
    "by",
    [
        S.Settings(gain=0.1, a=2.0),
        S.Settings(gain=0.01, a=4.0, hot_count=60, slice_bytes=4000, min_count=8),
        S.Settings(gain=0.3, a=2.0, hot_count=25, slice_bytes=900, max_depth=4, min_count=5),
    ],
)
def test_scores_equal_a_plain_tree(spark, by):
    """Also with contexts spread over buckets by their next words, and with small slices."""
    rows = corpus(1, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = compare(S.score_documents(docs, by=by).collect(), rows, by)
    assert {1, 2, 3} <= {len(s) for s in kept}


def test_no_context_is_left_out(spark):
    """The default tree is the one of all contexts, those that occur once among them."""
    rows = [(d, t) for d, t in corpus(7, 250)] + [(1000, "p1 p2 p3 p4 p5"), (1001, "p1 p2 p3 p4 p5"), (1002, "q1 q2 q3 q4 q5")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = S.score_documents(docs, S.F.lit(False)).collect()
    kept = {r["doc_id"]: r for r in got}
    assert kept[1000]["context_words"] > 0 == kept[1002]["context_words"]
    by = S.Settings(min_count=1, min_share=0.0)
    learnt = [(d, t) for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    same = spark.createDataFrame(learnt, "doc_id long, text string")
    found = compare(S.score_documents(same).collect(), learnt, by)
    seen = Counter(tuple(w[i : i + k]) for _, t in learnt for w in [tokens(t)[:-1]] for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert min(seen[s] for s in found) == 2
    assert S.Totals(10**13, 10**9, 12, [], S.Settings()).least == 2


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    compare(S.score_documents(docs).collect(), rows)
    assert S.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([("x", "a b"), (None, None)], "doc_id string, text string")
    got = S.score_documents(one, S.F.lit(True)).collect()
    assert [(r["train_tokens"], r["score"]) for r in got] == [(0, 0.0)] * 2


def test_packed_counts():
    values = np.array([0, 1, 254, 255, 256, 1 << 40, 3])
    assert S.unpacked(S.packed(values), len(values)).tolist() == values.tolist()


def test_held_out_scores_beat_the_base(spark, sf_dir):
    got = S.op12_suffix_tree(spark, sf_dir)
    row = got.filter("held_out").selectExpr("sum(score) s", "sum(base_score) b", "sum(n_tokens) n", "sum(context_words) c").first()
    assert row["s"] > row["b"] and row["c"] > 0


def test_slices_are_not_shuffled_again(spark, sf_dir):
    """Only answers move: the stored slices are read in their buckets."""
    plan = S.op12_suffix_tree(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
