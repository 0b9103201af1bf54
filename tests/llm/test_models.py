"""The models: training, held-out accuracy, and what they do with awkward rows."""

import math
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from edges import SCHEMA, edge_docs, texts_of, words
from turnloom.llm.labelled_pages import LAYOUTS
from turnloom.llm import html_extract as H, resampling as R, toxicity as X
from turnloom.llm.common import table


def small_net(seed=1):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(240):
        w = words(rng, rng.randrange(10, 120)).split()
        if i % 3 == 0:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["vile", "vileness", "rotten,"])
        texts.append(" ".join(w))
        labels.append(int(i % 3 == 0))
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def net():
    return X.train(*small_net())


def test_network_learns_and_sees_whole_texts(net):
    texts, labels = small_net(2)
    assert ((net.score(pa.array(texts)) >= 0.5) == labels).mean() > 0.97
    long = words(random.Random(3), 20_000)
    scores = net.score(pa.array([long, f"{long} vile {long} rotten", None, "", "!!"]))
    assert scores[0] < 0.5 < scores[1] and scores[2:].tolist() == [0, 0, 0]


def test_training_runs_in_a_task(spark, monkeypatch):
    """The driver holds neither the sample nor what training needs, and its network is the same."""
    texts, labels = small_net(5)
    rows = [(i, t, int(y)) for i, (t, y) in enumerate(zip(texts, labels))]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(5)
    used = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5]
    want = X.train(pa.array([texts[i] for i in used]), labels[used])

    def refused(*_):
        raise AssertionError("trained on the driver")

    monkeypatch.setattr(X, "train", refused)
    got = X.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert got.p.keys() == want.p.keys()
    for name, value in want.p.items():
        assert np.allclose(got.p[name], value, atol=1e-4)
    assert X.fit(df, df.filter("toxic = 0")) is None and X.fit(df.limit(0), df) is None


def test_gradients(net):
    texts, labels = small_net(4)
    tokens = X.tokens_of(pa.array(texts[:6]))
    starts, rows = X.windows_of(tokens.at)
    net = X.Network(X._started(tokens, labels[:6], 0)[0].known, 3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        z = net.logits(tokens, starts, rows).astype(np.float64)
        y = labels[rows]
        return np.mean(np.logaddexp(0, z) - y * z)

    g = net.gradients(tokens, starts, rows, labels[rows])
    for name in ("fore_state", "back_in", "attend", "out", "word", "char3", "char6"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        before, value = net.p[name][at], []
        for step in (1e-2, -1e-2):
            net.p[name][at] = before + step
            value.append(loss())
        net.p[name][at] = before
        assert (value[0] - value[1]) / 2e-2 == pytest.approx(float(g[name][at]), rel=0.05, abs=1e-5)


def plain_score(net, text):
    """The score of a text, one window, word and step at a time."""
    words = [w for w in "".join(chr(c) if not X.SEPARATOR[c] else " " for c in text.lower().encode()).split(" ") if w]
    inputs = []
    for w in words:
        own = X.tokens_of(pa.array([w.encode("latin-1").decode()]))
        parts = [net.p["word"][net.known["word"].find(own.hashes)[0]]]
        for k, run in enumerate(X.RUNS):
            padded = " " + w + " "
            assert len(own.grams[k]) == max(1, len(padded) + 1 - run)
            at = net.known[f"char{run}"].find(own.grams[k])
            parts.append(sum(net.p[f"char{run}"][a] for a in at) / len(at))
        inputs.append(np.concatenate(parts).astype(np.float64))
    logistic = lambda x: 1 / (1 + np.exp(-x))
    h, best = X.HIDDEN, -math.inf
    last = max(len(words) - X.LENGTH, 0)
    for start in sorted({min(s, last) for s in range(0, last + X.STRIDE, X.STRIDE)}):
        window = inputs[start : start + X.LENGTH]
        both = []
        for way in ("fore", "back"):
            state, states = np.zeros(h), []
            for x in window if way == "fore" else window[::-1]:
                a = x @ net.p[f"{way}_in"] + net.p[f"{way}_bias"]
                u = state @ net.p[f"{way}_state"]
                z, r = logistic(a[:h] + u[:h]), logistic(a[h : 2 * h] + u[h : 2 * h])
                new = np.tanh(a[2 * h :] + r * u[2 * h :])
                state = z * state + (1 - z) * new
                states.append(state)
            both.append(states if way == "fore" else states[::-1])
        states = np.array([np.concatenate(x) for x in zip(*both)])
        weight = np.exp(np.tanh(states @ net.p["attend"]) @ net.p["attend_out"])
        pooled = (weight / weight.sum()) @ states
        best = max(best, float(pooled @ net.p["out"] + net.p["bias"][0]))
    return logistic(best) if words else 0.0


def test_scores_equal_a_plain_forward_pass(net):
    texts = [*small_net(5)[0][:8], "vile", words(random.Random(7), 100).encode("ascii", "ignore").decode()]
    texts = [t.encode("ascii", "ignore").decode() for t in texts]
    assert net.score(pa.array(texts)) == pytest.approx([plain_score(net, t) for t in texts], abs=1e-4)


def test_slices_of_a_sample_merge_to_the_same_tokens():
    texts, _ = small_net(6)
    whole = X.tokens_of(pa.array(texts))
    joined = X.merged([X.tokens_of(pa.array(texts[k : k + 50])) for k in range(0, len(texts), 50)])
    for a, b in zip([whole.hashes, whole.ids, whole.at, *whole.grams, *whole.first],
                    [joined.hashes, joined.ids, joined.at, *joined.grams, *joined.first]):
        assert np.array_equal(a, b)


def test_contradicting_labels_and_repeated_rows_do_not_change_the_network(spark):
    texts, y = small_net(8)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, toxic int")
    more = spark.createDataFrame([(300, 0), (300, 1)], labels.schema)
    one = X.fit(docs, labels)
    two = X.fit(
        docs.unionByName(docs.limit(40)).unionByName(spark.createDataFrame([(300, "x y z")], docs.schema)).repartition(5),
        labels.unionByName(more).unionByName(labels),
    )
    assert all(np.array_equal(one.p[k], two.p[k]) for k in one.p)


def test_windows_overlap_and_cover():
    sizes = np.array([0, 1, 31, 32, 33, 56, 57, 500])
    at = np.append(0, np.cumsum(sizes))
    starts, rows = X.windows_of(at)
    for row, size in enumerate(sizes):
        mine = starts[rows == row] - at[row]
        seen = {w for s in mine for w in range(s, min(s + X.LENGTH, size))}
        assert seen == set(range(size))
        twice = [w for w in range(X.LENGTH, size - X.LENGTH) if sum(s <= w < s + X.LENGTH for s in mine) < 2]
        assert not twice


def test_scores_of_edge_rows(spark, net):
    docs = edge_docs(spark)
    got = X.score(docs, net)
    assert got.count() == docs.count() and set(got.columns) == set(docs.columns)
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert X.drop_toxic(docs, net).columns == docs.columns
    assert X.drop_toxic(docs, None).count() == docs.count()
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([(5, None), (6, 1), (None, 0), (99, 0)], "doc_id long, toxic int")
    assert X.score(none, net).collect() == [] and X.fit(none, labels) is None
    assert X.fit(docs, labels) is None


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = X.op3_gated_recurrent(spark, sf_dir).filter("held_out").join(
        table(spark, sf_dir, "labels"), "doc_id"
    )
    rows = got.select("toxic", "predicted").collect()
    right = sum(r["toxic"] == r["predicted"] for r in rows) / len(rows)
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert len(rows) > 500 and right > 0.95
    # 53 of 97 hold marker words; the rest differ from clean texts by rare beginnings of words.
    assert len(toxic) > 80 and sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.02


PAGE = """<html><head><title>t</title><script>if (a < b) x("</p>")</script></head><body>
<nav><ul><li><a href=/a>a</a></li></ul></nav><article><h1>Head&amp;line</h1>
<p>First   <b>bold</b> &lt;tag&gt; 1 < 2
text.</p><p>Second &eacute; &am</p><div class="comments"><p>Nice one.</p></div></article>
<footer>&copy; site</footer></body></html><div"""


def test_pages(spark):
    rows = [
        (1, "u", PAGE, "old"),
        (2, None, None, None),
        (3, "u", "", "old"),
        (4, "u", "<article>" + "<p>A longer sentence stands here for ever.</p>" * 3000 + "</article>", None),
        (5, "u", "<p>no end", None),
        (1, "u", PAGE, "old"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(H.extract(pages).collect(), key=lambda r: r["page_id"])
    assert got[0]["text"] == "Head&line\nFirst bold <tag> 1 < 2 text.\nSecond é &am" == got[1]["text"]
    assert got[2]["text"] == "" == got[3]["text"]
    assert len(got[4]["text"].split("\n")) == 3000
    assert H.extract(pages.limit(0)).collect() == []


def test_marginals_are_exact():
    """Against the sum over all labelings of a small tree."""
    model = H.trained_model()
    page = H.read_page("<div><p>One two.</p><ul><li>x</li><li><a>y</a></li></ul></div>")
    forest = H.Forest.of([page])
    got, _ = model.marginals(forest)
    n = forest.size
    unary = np.bincount(forest.at, model.node[forest.features], n)
    total, on = 0.0, np.zeros(n)
    for code in range(1 << n):
        y = [(code >> k) & 1 for k in range(n)]
        s = sum(unary[k] * y[k] for k in range(n))
        s += sum(model.edge[forest.kind[k], y[forest.parent[k]], y[k]] for k in range(1, n))
        total += math.exp(s)
        on += math.exp(s) * np.array(y)
    assert got == pytest.approx(on / total)


def right_runs(model, pages):
    """Of each run of text: whether its label is found."""
    marginal, _ = model.marginals(H.Forest.of(pages))
    truth = np.array([m for p in pages for m in p.marked])
    runs = np.array([t is not None for p in pages for t in p.text])
    return ((marginal > 0.5) == truth)[runs]


def test_held_out_layouts():
    """Each layout by a model that was trained on the pages of other layouts only, so without
    its names: 0.82 of the runs of text come out right."""
    train, test, k = H.labelled_pages(4), H.labelled_pages(4, seed=99), len(LAYOUTS)
    right = []
    for fold in range(5):
        model = H.TreeModel.trained([H.read_page(p) for i, p in enumerate(train) if i % k % 5 != fold])
        right.append(right_runs(model, [H.read_page(p) for i, p in enumerate(test) if i % k % 5 == fold]))
    assert np.concatenate(right).mean() > 0.8


LONG = "It rained for three days and the river rose over its banks."
PLAIN_PAGES = [
    (f"<div><a href=/>Home</a> <a href=/n>News</a></div><div><h1>Rain</h1><p>{LONG}</p></div><div>&copy; 2024 site</div>", f"Rain\n{LONG}"),
    (f"<nav><a href=/>x</a></nav><article><h1>Rain</h1><p>{LONG}</p></article><ol class=commentlist><li>{LONG}</li></ol>", f"Rain\n{LONG}"),
    (f"<ul id=topMenu><li>One<li>Two</ul><div class=postBody><p>{LONG}</p></div><div class=readercomments><p>{LONG}</p></div>", LONG),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
]


@pytest.mark.parametrize("source, want", PLAIN_PAGES)
def test_pages_without_names_and_joined_names(source, want):
    assert H.main_texts(H.trained_model(), [f"<html><body>{source}</body></html>"]) == [want]


DEEP_PAGES = [
    "<div>" * 20000 + "x",
    "<td><table>" + "<div>" * 20000 + "<td></td>" * 20000 + "x",
    "<template>" + "<div>" * 20000 + "</p>" * 20000 + "</template>x",
    "<svg>" + "<style>" * 20000 + "</svg>x",
]


@pytest.mark.parametrize("source", DEEP_PAGES)
def test_deep_pages_are_read_in_linear_time(source):
    start = time.perf_counter()
    assert [t for t in H.read_page(source).text if t is not None] == ["x"]
    assert time.perf_counter() - start < 5


def test_other_fillings_and_given_pages(spark, sf_dir):
    model = H.trained_model()
    pages = [H.read_page(p) for p in H.labelled_pages(2, seed=99)]
    marginal, _ = model.marginals(H.Forest.of(pages))
    truth = np.array([m for p in pages for m in p.marked])
    assert ((marginal > 0.5) == truth).mean() > 0.99
    for r in H.op8_tree_model(spark, sf_dir).join(table(spark, sf_dir, "pages").drop("url"), "page_id").collect():
        page = H.read_page(r["html"].replace("<article>", "<article data-main>"))
        want = "\n".join(t for t, m in zip(page.text, page.marked) if t and m)
        assert (r["text"], r["n_chars"]) == (want, len(want))


def brute_weights(docs, good):
    raw, target, rows = np.zeros(R.BUCKETS), np.zeros(R.BUCKETS), {}
    for d, t in docs:
        _, b = R.features(pa.array([t], pa.string()))
        raw += np.bincount(b, minlength=R.BUCKETS)
        if d in good:
            target += np.bincount(b, minlength=R.BUCKETS)
        rows[d] = b
    ratio = np.log((target + 1) / (target.sum() + R.BUCKETS) * (raw.sum() + R.BUCKETS) / (raw + 1))
    return {d: ratio[b].mean() * R.STANDARD if len(b) else 0.0 for d, b in rows.items()}


def test_resampling_on_documents(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = {r[0] for r in labels.filter("quality = 1").select("doc_id").collect()}
    got = {r["doc_id"]: r for r in R.op10_importance(spark, sf_dir).collect()}
    want = brute_weights(texts_of(docs), good)
    assert {d: round(r["log_weight"], 6) for d, r in got.items()} == {d: round(w, 6) for d, w in want.items()}
    chosen = sorted(got, key=lambda d: -got[d]["key"])[: len(got) // 2]
    assert sorted(chosen) == sorted(d for d, r in got.items() if r["selected"])
    bad = [r[0] for r in labels.filter("quality = 0").select("doc_id").collect()]
    share = lambda ids: np.mean([got[d]["selected"] for d in ids])
    assert share(bad) < share(good)


def test_resampling_edges(spark, monkeypatch):
    monkeypatch.setattr(R, "BITS", 2)
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    got = R.resample(docs, labels).collect()
    assert len(got) == docs.count() and sum(r["selected"] for r in got) == docs.count() // 2
    lowest = min(r["key"] for r in got if r["selected"])
    assert all(r["selected"] or r["key"] <= lowest for r in got)
    assert R.resample(docs.limit(0), labels).collect() == []
    none = R.resample(docs, labels.limit(0)).collect()
    assert all(r["log_weight"] == 0 for r in none)


SKIPPED_CASES = [
    "<head><script>for(i=0;i<n;i++){} // don't</script></head><body><article><p>It's here</p></article>",
    "<head><title>t</title><meta name=x><article><p>It's here</p></article>",
    "<head><title>t</title>\n It's here",
    "<html><head><noscript><img src=x></head><p>It's here</p>",
    "<body><div><button>Menu</div><p>It's here</p>",
    "<body><ul><li><select><option>One<li>It's here</ul>",
    "<body><div><noscript><p>No</div><p>It's here</p>",
    "<body><div><svg><path></div><p>It's here</p>",
    "<body><svg><title/><path><p>It's here</p>",
    "<body><button>Menu<article><p>It's here</p></article></body>",
    "<body><button><div>No</div><b>no</b></button><svg><style>a</style><desc><p>no</p></desc></svg><p>It's here",
    "<body><select><option>no</select><template><table><tr><td><p>no</table></template><p>It's here",
    "<body><object><object>no</object><script>'</object>'</script>no</object><p>It's here",
]


@pytest.mark.parametrize("source", SKIPPED_CASES)
def test_skipped_elements_end(source):
    assert [t for t in H.read_page(source).text if t is not None] == ["It's here"]


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_all_good_rows_are_counted(spark, monkeypatch, broadcast):
    monkeypatch.setattr(R, "TARGET_ROWS", 3, raising=False)
    monkeypatch.setattr(R, "BROADCAST_IDS", broadcast, raising=False)
    rng = random.Random(14)
    rows = [(i, words(rng, 30)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60) for _ in range(2)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["log_weight"] for r in R.resample(docs, labels).collect()}
    assert got == pytest.approx(brute_weights(rows, set(range(1, 60, 2))))
