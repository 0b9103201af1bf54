"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is cut into words (runs of letters and digits, ASCII lower-cased) and into windows
of ``LENGTH`` words that begin every ``STRIDE`` words; the last window ends with the text, and
every word but the first and last few lies in at least two windows.
The input of a word is an embedding of the word and the means of the embeddings of its character
runs of three and of six bytes; words and runs of fewer than ``MIN_TEXTS`` training texts, and
all that training has not seen, have the embedding 0. Two gated recurrent units read a window from both ends,
attention weighs their states, and a logistic unit scores the weighted mean. The score of a text
is that of its worst window, so every window of the whole text is scored.

Training needs labels of texts only: the window with the highest score stands for its text
(chosen anew in every epoch; at first by the log odds of words and runs, which also start the
embeddings). In each step the word input of a share ``DROP`` of the words is blanked, so that
characters have to carry words that training has not seen, and embeddings decay.
The sample is bounded by ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` labelled rows and ``SAMPLE_BYTES``
bytes of text of each kind, in the order of a hash among the rows of at most ``SAMPLE_CHARS``
characters whose crc32(doc_id) mod 5 is not 0; one task tokenises it in slices and trains, and
only the network reaches the driver. Scoring is a map over whole texts, without a shuffle; a text
of any length is scored whole, in blocks of windows.

Defined results: a null or empty text, or one without a word, scores 0; without labels of
both kinds every score is 0; repeated rows score alike; a label row without a document is not
used, nor are labels that contradict each other; of different texts under one doc_id the least
is learnt from; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from turnloom.llm.common import ship, table
from turnloom.llm.words import hash_words, mixed, slices

LENGTH = 32
STRIDE = 12
KNOWN = 1 << 15  # words, and character runs of a length, that have an embedding, at most
SLOTS = 18  # bits of a hash that find them
MIN_TEXTS = 6
COUNT_SLOTS = 21  # bits of a hash under which texts are counted
RUNS = (3, 6)  # bytes of a character run
DIM = 12  # of each embedding
INPUTS = DIM * (1 + len(RUNS))
HIDDEN = 12  # of each direction
SAMPLE_TOXIC = 1500
SAMPLE_CLEAN = 3000
SAMPLE_CHARS = 12_000
SAMPLE_BYTES = 4_000_000
EPOCHS = 6
STEPS = 250  # at least; a small sample is gone through more often
DROP = 0.5
DECAY = 0.002
BATCH = 128
RATE = 0.005
BLOCK = 4096  # windows scored at once
SLICE = 2_000_000  # bytes of text that share their distinct words

SEPARATOR = np.array(
    [not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) for c in range(256)]
)


@dataclass
class Tokens:
    """Hashes of distinct words, and the texts as indices into them.

    ``grams[k][first[k][w]:]`` are the hashes of the character runs of kind k of word w, at
    least one.
    """

    hashes: np.ndarray
    grams: list[np.ndarray]
    first: list[np.ndarray]
    ids: np.ndarray
    at: np.ndarray

    def sizes(self, kind: int) -> np.ndarray:
        return np.diff(np.append(self.first[kind], len(self.grams[kind])))

    def part(self, used: np.ndarray) -> Tokens:
        """The distinct words ``used`` alone."""
        grams, first = [], []
        for kind in range(len(RUNS)):
            sizes = self.sizes(kind)[used]
            begin = np.cumsum(sizes) - sizes
            at = np.repeat(self.first[kind][used] - begin, sizes) + np.arange(sizes.sum())
            grams.append(self.grams[kind][at])
            first.append(begin)
        return Tokens(self.hashes[used], grams, first, self.ids, self.at)


def tokens_of(texts: pa.Array) -> Tokens:
    words = hash_words(texts, lower=True, space=SEPARATOR)
    hashes, one, ids = np.unique(words.hashes, return_index=True, return_inverse=True)
    starts, sizes = words.starts[one], (words.ends - words.starts)[one]
    # The bytes of each distinct word between spaces, at least as many as a run needs.
    width = np.maximum(sizes + 2, max(RUNS))
    first = np.cumsum(width) - width
    padded = np.full(int(width.sum()), 32, dtype=np.int64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    padded[first[of] + 1 + inner] = words.data[starts[of] + inner]
    grams, begin = [], []
    for run in RUNS:
        count = np.maximum(sizes + 3 - run, 1)
        begin.append(np.cumsum(count) - count)
        at = np.repeat(first - begin[-1], count) + np.arange(count.sum())
        code = np.zeros(len(at), dtype=np.uint64)
        for k in range(run):
            code = code * np.uint64(257) + padded[at + k].astype(np.uint64)
        grams.append(mixed(code))
    return Tokens(hashes, grams, begin, ids.astype(np.int32), words.at)


def merged(parts: list[Tokens]) -> Tokens:
    """The tokens of consecutive slices of texts as one."""
    _, one, place = np.unique(
        np.concatenate([p.hashes for p in parts]), return_index=True, return_inverse=True
    )
    grams = [np.concatenate([p.grams[k] for p in parts]) for k in range(len(RUNS))]
    sizes = [np.concatenate([p.sizes(k) for p in parts]) for k in range(len(RUNS))]
    hashes = np.concatenate([p.hashes for p in parts])
    every = Tokens(hashes, grams, [np.cumsum(n) - n for n in sizes], parts[0].ids, parts[0].at)
    own = every.part(one)
    low = np.cumsum([0, *(len(p.hashes) for p in parts)])
    begin = np.cumsum([0, *(len(p.ids) for p in parts)])
    ids = np.concatenate([place[n : n + len(p.hashes)][p.ids] for n, p in zip(low, parts)])
    at = np.concatenate([[0], *(p.at[1:] + n for n, p in zip(begin, parts))])
    return Tokens(own.hashes, own.grams, own.first, ids.astype(np.int32), at)


def windows_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and row of each window; rows of up to LENGTH words have one."""
    sizes = np.diff(at)
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - LENGTH) // STRIDE)), 0)
    rows = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]
    start = np.minimum(nth * STRIDE, np.maximum(sizes[rows] - LENGTH, 0))
    return at[rows] + start, rows


def gathered(tokens: Tokens, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word indices of windows, and a mask that is 0 beyond the end of a short text."""
    at = starts[:, None] + np.arange(LENGTH)
    mask = at < tokens.at[rows + 1][:, None]
    return tokens.ids[np.minimum(at, len(tokens.ids) - 1)], mask.astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Vocabulary:
    """Places 1, 2, ... of known hashes in a table found by ``SLOTS`` bits; 0 for all others.

    Of hashes that share a slot the first has it.
    """

    def __init__(self, hashes: np.ndarray):
        _, first = np.unique(hashes >> np.uint64(64 - SLOTS), return_index=True)
        self.hashes = np.append(np.uint64(0), hashes[np.sort(first)])
        self.slots = np.zeros(1 << SLOTS, dtype=np.int32)
        self.slots[self.hashes[1:] >> np.uint64(64 - SLOTS)] = np.arange(1, len(self.hashes))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = self.slots[hashes >> np.uint64(64 - SLOTS)]
        return np.where(self.hashes[at] == hashes, at, 0)


class Network:
    """Parameters by name; ``score`` for use, ``gradients`` for training."""

    def __init__(self, known: dict[str, Vocabulary], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.known = known

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            **{k: normal(len(v.hashes), DIM, scale=0.1) for k, v in known.items()},
            "attend": normal(2 * HIDDEN, HIDDEN, scale=0.3),
            "attend_out": normal(HIDDEN, scale=0.3),
            "out": normal(2 * HIDDEN, scale=0.3),
            "bias": np.zeros(1, dtype=np.float32),
        }
        for way in ("fore", "back"):
            self.p[f"{way}_in"] = normal(INPUTS, 3 * HIDDEN, scale=0.3)
            self.p[f"{way}_state"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
            self.p[f"{way}_bias"] = np.zeros(3 * HIDDEN, dtype=np.float32)
        for kind in known:
            self.p[kind][0] = 0

    def inputs(self, tokens: Tokens) -> np.ndarray:
        """Word and character inputs of each distinct word."""
        if not len(tokens.hashes):
            return np.zeros((0, INPUTS), dtype=np.float32)
        chars = [
            np.add.reduceat(self.embedded(f"char{run}", tokens.grams[k]), tokens.first[k], axis=0)
            / tokens.sizes(k)[:, None].astype(np.float32)
            for k, run in enumerate(RUNS)
        ]
        return np.concatenate([self.embedded("word", tokens.hashes), *chars], axis=1)

    def embedded(self, kind: str, hashes: np.ndarray) -> np.ndarray:
        return self.p[kind][self.known[kind].find(hashes)]

    def _read(self, way: str, projected: np.ndarray, mask: np.ndarray | None, keep: bool):
        """States of one direction, [LENGTH, windows, HIDDEN]; what backward steps need."""
        h_dim, steps = HIDDEN, range(LENGTH) if way == "fore" else range(LENGTH - 1, -1, -1)
        state = np.zeros((projected.shape[1], h_dim), dtype=np.float32)
        states = np.empty((LENGTH, projected.shape[1], h_dim), dtype=np.float32)
        saved = {}
        for t in steps:
            x, u = projected[t], state @ self.p[f"{way}_state"]
            gates = sigmoid(x[:, : 2 * h_dim] + u[:, : 2 * h_dim])
            z, r = gates[:, :h_dim], gates[:, h_dim:]
            new = np.tanh(x[:, 2 * h_dim :] + r * u[:, 2 * h_dim :])
            before, state = state, new + z * (state - new)
            if mask is not None:
                state = state * mask[:, t, None]
            if keep:
                saved[t] = (before, z, r, new, u[:, 2 * h_dim :])
            states[t] = state
        return states, saved

    def forward(self, projected: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray, keep: bool):
        """Logits of windows of words with projected inputs; and what ``gradients`` needs."""
        masked = mask if (mask == 0).any() else None
        halves, saved = [], {}
        for way in ("fore", "back"):
            states, saved[way] = self._read(way, projected[way][ids.T], masked, keep)
            halves.append(states)
        states = np.concatenate(halves, axis=2)
        inner = np.tanh(states @ self.p["attend"])
        weight = inner @ self.p["attend_out"]
        if masked is not None:
            weight = np.where(mask.T > 0, weight, np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        return pooled @ self.p["out"] + self.p["bias"], (states, inner, weight, pooled, saved)

    def project(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {w: inputs @ self.p[f"{w}_in"] + self.p[f"{w}_bias"] for w in ("fore", "back")}

    def logits(self, tokens: Tokens, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
        projected = self.project(self.inputs(tokens))
        out = np.empty(len(starts), dtype=np.float32)
        for low in range(0, len(starts), BLOCK):
            part = slice(low, low + BLOCK)
            ids, mask = gathered(tokens, starts[part], rows[part])
            out[part] = self.forward(projected, ids, mask, False)[0]
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        """Score of each text: the sigmoid of the highest logit of its windows."""
        tokens = tokens_of(texts)
        starts, rows = windows_of(tokens.at)
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, rows, self.logits(tokens, starts, rows))
        return np.where(np.isfinite(best), sigmoid(np.where(np.isfinite(best), best, 0.0)), 0.0)

    def gradients(
        self, tokens: Tokens, starts: np.ndarray, rows: np.ndarray, y: np.ndarray, rng=None
    ) -> dict:
        """Gradients of the mean cross entropy of windows with labels ``y``; with ``rng``, the
        word inputs of a share DROP of the words are blanked."""
        ids, mask = gathered(tokens, starts, rows)
        used, ids = np.unique(ids, return_inverse=True)
        ids = ids.reshape(mask.shape)
        own = tokens.part(used)
        inputs = self.inputs(own)
        seen = np.ones((len(used), 1), dtype=np.float32)
        if rng is not None:
            seen[rng.random(len(used)) < DROP] = 0
        inputs[:, :DIM] *= seen
        logit, (states, inner, weight, pooled, saved) = self.forward(
            self.project(inputs), ids, mask, True
        )
        d_logit = (sigmoid(logit) - y).astype(np.float32) / len(y)
        g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_weight = (states * d_pooled).sum(axis=2)
        d_weight = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_inner = d_weight[:, :, None] * self.p["attend_out"] * (1 - inner**2)
        g["attend_out"] = np.einsum("lb,lbh->h", d_weight, inner)
        g["attend"] = np.einsum("lbs,lbh->sh", states, d_inner)
        d_states = weight[:, :, None] * d_pooled + d_inner @ self.p["attend"].T
        d_inputs = np.zeros_like(inputs)
        for way, half in (("fore", slice(0, HIDDEN)), ("back", slice(HIDDEN, None))):
            d_in = self._back(way, d_states[:, :, half], mask, saved[way], g)
            flat = d_in.reshape(-1, 3 * HIDDEN)
            per_word = np.zeros((len(used), 3 * HIDDEN), dtype=np.float32)
            np.add.at(per_word, ids.T.ravel(), flat)
            g[f"{way}_in"] = inputs.T @ per_word
            g[f"{way}_bias"] = flat.sum(axis=0)
            d_inputs += per_word @ self.p[f"{way}_in"].T
        g["word"] = np.zeros_like(self.p["word"])
        np.add.at(g["word"], self.known["word"].find(own.hashes), d_inputs[:, :DIM] * seen)
        for k, run in enumerate(RUNS):
            sizes = own.sizes(k)
            shares = d_inputs[:, DIM * (k + 1) : DIM * (k + 2)] / sizes[:, None].astype(np.float32)
            g[f"char{run}"] = np.zeros_like(self.p[f"char{run}"])
            at = self.known[f"char{run}"].find(own.grams[k])
            np.add.at(g[f"char{run}"], at, np.repeat(shares, sizes, axis=0))
        for kind in self.known:
            g[kind][0] = 0
        return g

    def _back(self, way: str, d_states: np.ndarray, mask: np.ndarray, saved: dict, g: dict) -> np.ndarray:
        """Backward through time; returns the gradient of the projected inputs."""
        u = self.p[f"{way}_state"]
        d_in = np.empty((*d_states.shape[:2], 3 * HIDDEN), dtype=np.float32)
        g[f"{way}_state"] = np.zeros_like(u)
        d_state = np.zeros(d_states.shape[1:], dtype=np.float32)
        for t in range(LENGTH - 1, -1, -1) if way == "fore" else range(LENGTH):
            before, z, r, new, u_new = saved[t]
            d = (d_state + d_states[t]) * mask[:, t, None]
            d_new = d * (1 - z) * (1 - new**2)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * u_new * r * (1 - r)
            d_in[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            g[f"{way}_state"] += before.T @ d_u
            d_state = d * z + d_u @ u.T
        return d_in


def train(texts: pa.Array, labels: np.ndarray, seed: int = 0) -> Network:
    """A network for whole texts with labels 0 or 1."""
    rng = np.random.default_rng(seed)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    tokens = merged([tokens_of(part.column("text")) for part in slices(batch)])
    starts, rows = windows_of(tokens.at)
    net, odds = _started(tokens, labels, seed)
    first = np.searchsorted(rows, np.arange(len(labels)))
    counts = np.diff(np.append(first, len(rows)))
    filled = np.flatnonzero(counts)
    value = np.empty(len(starts), dtype=np.float32)
    for low in range(0, len(starts), BLOCK):
        part = slice(low, low + BLOCK)
        ids, mask = gathered(tokens, starts[part], rows[part])
        value[part] = np.where(mask > 0, odds[ids], -np.inf).max(axis=1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, per_epoch = 0, -(-(len(filled) + int((labels[filled] == 0).sum())) // BATCH)
    for _ in range(max(EPOCHS, -(-STEPS // max(per_epoch, 1)))):
        # The best window of each text, and another one of each clean text.
        order = np.lexsort((-value, rows))
        best = order[first[filled]]
        other = first[filled] + rng.integers(0, counts[filled])
        chosen = np.concatenate([best, other[labels[filled] == 0]])
        rng.shuffle(chosen)
        for low in range(0, len(chosen), BATCH):
            part = chosen[low : low + BATCH]
            step += 1
            g = net.gradients(tokens, starts[part], rows[part], labels[rows[part]], rng)
            for k, v in g.items():
                m, s = moments[k]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                if k.startswith(("word", "char")):
                    net.p[k] *= 1 - DECAY
                net.p[k] -= rate * m / (np.sqrt(s) + 1e-8)
        value = net.logits(tokens, starts, rows)
    return net


def _started(tokens: Tokens, labels: np.ndarray, seed: int) -> tuple[Network, np.ndarray]:
    """A network whose embeddings begin with the log odds of words and runs between the
    classes, by texts; and the highest of them for each distinct word."""
    kinds = ["word", *(f"char{run}" for run in RUNS)]
    shift = np.uint64(64 - COUNT_SLOTS)
    counts = {k: np.zeros((2, 1 << COUNT_SLOTS), dtype=np.int16) for k in kinds}
    for row, label in enumerate(labels.tolist()):
        own = tokens.part(np.unique(tokens.ids[tokens.at[row] : tokens.at[row + 1]]))
        for k, hashes in zip(kinds, (own.hashes, *own.grams)):
            counts[k][label][np.unique(hashes >> shift)] += 1
    share = (labels == 1).sum() / max((labels == 0).sum(), 1)
    known, odds = {}, {}
    for k, hashes in zip(kinds, (tokens.hashes, *tokens.grams)):
        hashes = np.unique(hashes)
        n = counts[k][:, hashes >> shift].astype(np.int64)
        often = np.flatnonzero(n.sum(axis=0) >= MIN_TEXTS)
        often = often[np.argsort(-n[:, often].sum(axis=0), kind="stable")[:KNOWN]]
        known[k] = Vocabulary(hashes[often])
        n = counts[k][:, known[k].hashes >> shift].astype(np.float64)
        odds[k] = np.log((n[1] + 1) / (n[0] * share + 1)).astype(np.float32)
        odds[k][0] = 0
    net = Network(known, seed)
    for k, value in odds.items():
        net.p[k][:, 0] = value / 2
    best = odds["word"][known["word"].find(tokens.hashes)]
    for k, run in enumerate(RUNS):
        own = odds[f"char{run}"][known[f"char{run}"].find(tokens.grams[k])]
        best = np.maximum(best, np.maximum.reduceat(own, tokens.first[k]))
    return net, best


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Network | None:
    """A network trained on a bounded sample; None if a class has no usable row."""
    usable = (
        labels.filter(~held_out("doc_id") & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).alias("_y"), F.max(label).alias("_most"))
        .filter("_y = _most")
    )
    texts = docs.filter(F.length("text").between(1, SAMPLE_CHARS)).select("doc_id", "text")
    order = [F.md5(F.col("doc_id").cast("string")), "doc_id"]
    ranked = usable.filter("_y = 1").orderBy(*order).limit(SAMPLE_TOXIC).unionByName(
        usable.filter("_y = 0").orderBy(*order).limit(SAMPLE_CLEAN)
    )
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN rows; the windows below run over them alone.
    found = (
        texts.join(F.broadcast(ranked), "doc_id").groupBy("doc_id", "_y").agg(F.min("text").alias("text"))
    )
    so_far = F.sum(F.octet_length("text")).over(W.partitionBy("_y").orderBy(*order))
    sample = found.withColumn("_bytes", so_far).filter(F.col("_bytes") <= SAMPLE_BYTES)
    rows = sample.select("doc_id", "text", "_y").coalesce(1).sortWithinPartitions("doc_id")
    ship(docs.sparkSession)
    found = rows.mapInArrow(_trained, "net binary").toArrow().column("net").to_pylist()
    return pickle.loads(found[0]) if found else None


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The network of all rows of the sample; nothing if a class has none."""
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    y = rows.column("_y").to_numpy().astype(np.int64)
    if y.min() < y.max():
        net = train(rows.column("text").combine_chunks(), y)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["net"])


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``score`` (replaced if it is there)."""
    kept = [f for f in docs.schema.fields if f.name != "score"]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in kept])
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(net)  # at most 9 MB

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            for part in slices(batch, SLICE):
                values = net.score(part.column("text")) if net else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(values.astype(np.float64))],
                    [*part.schema.names, "score"],
                )

    return docs.mapInArrow(scored, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def drop_toxic(docs: DataFrame, net: Network | None, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; same columns."""
    own = "score" in docs.columns
    scored = score(docs.withColumnRenamed("score", "_doc_score") if own else docs, net)
    kept = scored.filter(F.col("score") < threshold).drop("score")
    kept = kept.withColumnRenamed("_doc_score", "score") if own else kept
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_gated_recurrent(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, net).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
