"""Mixing, sharding, divergence rules and quotation linking against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from edges import SCHEMA, edge_docs, texts_of, words
from helpers import assert_same, duck
from turnloom.llm import divergence as V, mixing as M, quotation as Q, sharding as S
from turnloom.llm.common import table
from turnloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, sf_dir, name):
    assert assert_same(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) > 0


def plan(sizes, weights, share, repeats):
    """Targets by sharing again until no source is above its limit."""
    targets = dict.fromkeys(sizes, 0.0)
    budget, open_ = sum(sizes.values()) * share, set(sizes)
    while open_:
        level = (budget - sum(targets[s] for s in sizes if s not in open_)) / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * level > repeats * sizes[s]}
        for s in over or open_:
            targets[s] = min(weights[s] * level, float(repeats * sizes[s]))
        open_ = open_ - over if over else set()
    return targets


def test_targets(spark):
    rng = random.Random(1)
    for _ in range(4):
        sizes = {f"={k:02}": rng.choice([0, 1, 5, 100, 10_000]) for k in range(9)} | {"": 50}
        names = [*sorted(s for s in sizes if s), ""]
        weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
        rows = spark.createDataFrame(list(sizes.items()), "_mix_key string, source_size long")
        got = {r["_mix_key"]: r["target"] for r in M.source_targets(rows).collect()}
        assert got == pytest.approx(plan(sizes, weights, 1.5, 2))


def test_mix_edges(spark):
    docs = edge_docs(spark)
    rows = M.mix_plan(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["taken"] % r["size"] == 0 and r["taken"] <= 2 * r["size"] for r in rows if r["size"])
    total = sum(r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) <= 1.5 * total
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    taken = Counter()
    for r in mixed.collect():
        taken[r["doc_id"]] += len((r["text"] or "").split())
    want = Counter()
    for r in rows:
        want[r["doc_id"]] += r["taken"]
    assert +taken == +want
    assert M.mix_plan(spark.createDataFrame([], SCHEMA)).collect() == []
    assert M.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_mix_of_many_sources_comes_near_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 40), f"s{min(int(rng.expovariate(0.7)), 6)}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix_plan(docs).collect()
    by = defaultdict(lambda: [0, 0.0])
    for r in got:
        by[r["_mix_key"]][0] += r["taken"]
        by[r["_mix_key"]][1] = r["target"]
    assert all(abs(t - w) <= 80 for t, w in by.values())
    again = M.mix_plan(docs.repartition(7)).collect()
    key = lambda r: r["doc_id"]
    assert [r["taken"] for r in sorted(got, key=key)] == [r["taken"] for r in sorted(again, key=key)]


def assert_shards(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BLOCK", 50)
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 4)
    docs = edge_docs(spark)
    got = S.shard_rows(docs, 4)
    assert_shards(got.collect(), 4)
    assert set(got.columns) == {*docs.columns, "slot"}
    assert sorted(map(repr, texts_of(got))) == sorted(map(repr, texts_of(docs)))
    assert S.shard_rows(docs.limit(0), 4).collect() == []
    many = spark.range(1003).withColumnRenamed("id", "doc_id")
    first, again = (S.shard_rows(many.repartition(n), 10, seed=3).collect() for n in (3, 5))
    assert_shards(first, 10)
    assert sorted(first) == sorted(again)
    # A uniform shuffle: neighbours in the input are spread over shards and slots.
    other = {r["doc_id"]: r["shard"] for r in S.shard_rows(many, 10, seed=4).collect()}
    same = sum(other[r["doc_id"]] == r["shard"] for r in first) / len(first)
    assert 0.05 < same < 0.16


def test_hypergeometric_law():
    rng = np.random.default_rng(0)
    for good, bad, draws in ((5, 7, 4), (40, 60, 30), (3, 0, 2), (0, 4, 2), (6, 2, 8)):
        got = np.array([S.draw_hypergeometric(rng, good, bad, draws) for _ in range(4000)])
        p = [math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws) for k in range(draws + 1)]
        seen = np.bincount(got, minlength=draws + 1) / len(got)
        assert np.abs(seen - p).max() < 0.035
    huge = [S.draw_hypergeometric(rng, 10**10, 3 * 10**10, 10**6) for _ in range(300)]
    assert abs(np.mean(huge) - 250_000) < 150
    matrix = S.communication_matrix([7, 0, 13, 22], 5, 1)
    assert matrix.sum(axis=1).tolist() == [7, 0, 13, 22] and matrix.sum(axis=0).tolist() == [9, 9, 8, 8, 8]


SPACE = " \t\n\x0b\x0c\r"


def base(text):
    for c in SPACE[1:]:
        flat = (text or "").replace(c, " ") if c == "\t" else flat.replace(c, " ")
    w = [x for x in flat.split(" ") if x]
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = {k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit), failed


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_rules_on_documents(spark, sf_dir):
    text = dict(texts_of(table(spark, sf_dir, "documents")))
    for r in V.op2_divergence(spark, sf_dir).collect():
        assert tuple(r[c] for c in NAMES) == base(text[r["doc_id"]])


def test_base_rules_on_edges(spark):
    rng = random.Random(6)
    part = words(rng, 11)
    more = [f"{part} {words(rng, 9)}\n{part} {part}\n\n{part} {part}\n \n \n", "é à " * 20, "a\x0bb\x0cc\rd\xa0e f"]
    docs = edge_docs(spark, more)
    got = V.judge(docs)
    assert got.count() == docs.count() and V.judge(docs.limit(0)).collect() == []
    for r in got.collect():
        assert tuple(r[c] for c in NAMES) == base(r["text"])
        assert not (r["kept"] and r["base_failed"])


def test_js_distance(spark):
    df = spark.createDataFrame([([3, 0, 7], 10, [0.1, 0.4, 0.5])], "c array<long>, n long, q array<double>")
    from pyspark.sql import functions as F

    got = df.select(V.js_distance(F.col("c"), F.col("n"), F.col("q"))).first()[0]
    p, q = [0.3, 0.0, 0.7], [0.1, 0.4, 0.5]
    kl = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    assert got == pytest.approx(math.sqrt((kl(p, q) + kl(q, p)) / 2))


def test_rules_know_clean_from_junk(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = V.op2_divergence(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").collect()
    kept = {q: np.mean([r["kept"] for r in rows if r["quality"] == q and r["n_words"] >= 20]) for q in (0, 1)}
    assert kept[1] > 0.97 and kept[0] < 0.2


def reply_order(messages):
    """Per conversation: (position, turn, parent_turn, depth, own text), by the definition."""
    out = {}
    for conv in {m[0] for m in messages}:
        turns = sorted((t, x) for c, t, x in messages if c == conv)
        own, parent, first = {}, {}, {}
        for k, (t, x) in enumerate(turns):
            lines = [(len(l) - len(l.lstrip("> ")), l) for l in (x or "").split("\n")]
            level = [l[: len(l) - len(l.lstrip("> "))].count(">") for _, l in lines]
            body = [l.lstrip("> ") if v else l for v, (_, l) in zip(level, lines)]
            flat = [" ".join(b.lower().split()) for b in body]
            votes = Counter()
            for v, f in zip(level, flat):
                if v and len(f) >= Q.MIN_CHARS and f in first:
                    votes[v, first[f]] += len(f)
            parent[t] = None if k == 0 else turns[k - 1][0]
            if votes:
                parent[t] = max(votes, key=lambda c: (-c[0], votes[c], c[1]))[1]
            for v, f in zip(level, flat):
                if not v:
                    first.setdefault(f, t)
            own[t] = None if x is None else "\n".join(b for v, b in zip(level, body) if not v).strip("\n \t")
        rows, stack = [], [(turns[0][0], 0)]
        while stack:
            t, depth = stack.pop()
            rows.append((len(rows), t, parent[t], depth, own[t]))
            stack += [(u, depth + 1) for u in sorted((u for u in parent if parent[u] == t), reverse=True)]
        out[conv] = rows
    return out


def test_quotes(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(12):
        texts = []
        for turn in range(rng.randrange(1, 14)):
            body = "\n".join(words(rng, rng.randrange(2, 9)) for _ in range(rng.randrange(1, 4)))
            if texts and rng.random() < 0.6:
                q = rng.choice(texts)
                quoted = "\n".join("> " + line for line in (q or "").split("\n")[: rng.randrange(1, 6)])
                body = f"{quoted}\n{body}" if rng.random() < 0.7 else f"{body}\n{quoted.upper()}"
            texts.append(None if rng.random() < 0.05 else body)
            rows.append((conv, turn, texts[-1]))
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = defaultdict(list)
    for r in Q.link_quotes(df).collect():
        got[r["conv_id"]].append((r["position"], r["turn"], r["parent_turn"], r["depth"], r["text"]))
    assert {c: sorted(x, key=lambda r: r[0]) for c, x in got.items()} == reply_order(rows)


def test_quote_edges(spark):
    rows = [
        (None, None, None, None, 5),
        (1, 0, "user", "The first message here", 5),
        (1, 0, "user", "The first message here", 5),
        (1, 2, None, "> > the FIRST   message here\n>> nothing known\nOn Monday Ann wrote:\n> the first message here\nOk", 5),
        (2, 0, "user", "> quotes only, of nothing", None),
        (2, 1, "user", "", None),
        (2, 2, "user", "long " * 30_000, None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int")
    got = {(r["conv_id"], r["turn"]): r for r in Q.link_quotes(df).collect()}
    assert Q.link_quotes(df).count() == len(rows)
    assert got[1, 2]["text"] == "Ok" and got[1, 2]["parent_turn"] == 0 and got[1, 2]["n_quoted"] == 3
    assert got[2, 0]["text"] == "" and got[2, 1]["parent_turn"] == 0 and got[None, None]["text"] is None
    assert Q.link_quotes(df.limit(0)).collect() == []


def test_op6_keeps_turn_order_without_quotes(spark, sf_dir):
    rows = Q.op6_quotation(spark, sf_dir).collect()
    given = table(spark, sf_dir, "conversations").collect()
    assert len(rows) == len(given)
    text = {(r["conv_id"], r["turn"]): r["text"] for r in given}
    assert all(r["text"] == text[r["conv_id"], r["turn"]].strip("\n \t") for r in rows)
    assert all(r["position"] == r["depth"] for r in rows)


def parts_of(lines):
    """(places, text) of the lines, paragraphs and whole of a passage of (place, line)."""
    flat = [(k, " ".join(x.lower().split())) for k, x in lines]
    paragraphs, run = [], []
    for k, x in [*flat, (None, "")]:
        if x:
            run.append((k, x))
        elif run:
            paragraphs.append(run)
            run = []
    parts = [[x] for p in paragraphs for x in p] + paragraphs + [[x for p in paragraphs for x in p]]
    return [([k for k, _ in p], " ".join(x for _, x in p)) for p in parts if p]


def quoted_parents(messages):
    """turn -> parent turn of one conversation; every part of every length is looked for."""
    first, out = {}, {}
    for turn, text in sorted(messages):
        lines = text.split("\n")
        level = [x[: len(x) - len(x.lstrip("> "))].count(">") for x in lines]
        body = [x.lstrip("> ") if v else x for v, x in zip(level, lines)]
        passages = []
        for k, v in enumerate(level):
            if k and level[k - 1] == v:
                passages[-1][1].append((k, body[k]))
            else:
                passages.append((v, [(k, body[k])]))
        votes = Counter()
        for v, lines in passages:
            best = {}
            for places, text in parts_of(lines):
                if v and text in first:
                    for k in places:
                        best[k] = max(best.get(k, (0, 0)), (len(places), first[text]))
            for k, (_, t) in best.items():
                votes[v, t] += len(" ".join(body[k].lower().split()))
        out[turn] = max(votes, key=lambda c: (-c[0], votes[c], c[1]))[1] if votes else (turn - 1 if turn else None)
        own = [(v, x) for v, x in passages if not v] + [(0, [(k, x) for k, (v, x) in enumerate(zip(level, body)) if not v])]
        for _, lines in own:
            for _, text in parts_of(lines):
                first.setdefault(text, turn)
    return out


def test_short_and_rewrapped_quotes(spark):
    rng = random.Random(12)
    rows = []
    for conv in range(40):
        own = []
        for turn in range(rng.randrange(2, 12)):
            lines = [" ".join(rng.choice(["ja", "no", "ok", "go on"]) for _ in range(rng.randrange(0, 4))) for _ in range(rng.randrange(1, 6))]
            body = "\n".join(lines)
            text = body
            if own and rng.random() < 0.7:
                quote = rng.choice(own)
                if rng.random() < 0.5:
                    w = quote.split()
                    quote = "\n".join(" ".join(w[k : k + 3]) for k in range(0, len(w), 3))
                text = "\n".join("> " + x for x in quote.split("\n")) + "\n" + body
            own.append(body)
            rows.append((conv, turn, text))
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = defaultdict(dict)
    for r in Q.link_quotes(df).collect():
        got[r["conv_id"]][r["turn"]] = r["parent_turn"]
    for conv in range(40):
        assert got[conv] == quoted_parents([(t, x) for c, t, x in rows if c == conv])


def test_quotes_of_any_length_and_wrapping(spark):
    long = "one two three four five six seven"
    rows = [
        (1, 0, "Agreed."),
        (1, 1, "Something else"),
        (1, 2, "> Agreed.\nGood"),
        (2, 0, f"{long}\n\nlast part"),
        (2, 1, "no"),
        (2, 2, "> one two three\n> four five\n> six seven\nyes"),
        (2, 3, "> one two\n> three four five six seven last\n> part\nyes"),
        (3, 0, "好的。今天下午三点开会"),
        (3, 1, "x"),
        (3, 2, "> 好的。今天\n> 下午三点开会\n行"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {(r["conv_id"], r["turn"]): r["parent_turn"] for r in Q.link_quotes(df).collect()}
    assert [got[k] for k in ((1, 2), (2, 2), (2, 3), (3, 2))] == [0, 0, 0, 0]


def test_common_words_of_any_length(spark):
    rng = random.Random(13)
    pool = {"a": ["nicht", "mente", "because", "of", "it"], "": ["vielleicht", "to"]}
    docs = []
    for k in range(40):
        lang = None if k % 2 else "a"
        often = rng.choices(pool[lang or ""], k=30)
        docs.append((k, " ".join([*often, words(rng, 40)]), lang))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r["_js_lang"]: r for r in V.language_references(V.measured(df, ["doc_id"])).collect()}
    for lang in ("a", ""):
        counts = Counter("".join(c if c.isalpha() else " " for d in docs if (d[2] or "") == lang for c in d[1].lower() + " ").split())
        top = sorted(counts, key=lambda w: (-counts[w], w))[: V.COMMON]
        assert got[lang]["_js_common"] == top and any(len(w) > 4 for w in top)
        shares = [counts[w] / counts.total() for w in top]
        assert got[lang]["_js_share"] == pytest.approx([*shares, 1 - sum(shares)])
