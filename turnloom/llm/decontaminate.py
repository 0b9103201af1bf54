"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of all items (words, ASCII lower-cased) is built once on the driver and sent
to the tasks. Each document is streamed through it: at every word the state and the length
of the longest match that ends there are known. Where the match is at least ``window`` words
long, the last ``window`` words are a window of some item; the state tells of which ones.
Items shorter than a window count as one window, found through marks on the suffix links.
Words outside the items' vocabulary send the automaton back to its root, so only runs of
known words are walked.

The items are the small side: their words are counted first, and they are cut into
automata of at most ``BLOCK_WORDS`` words, through which every document is streamed one
after another. More than ``MAX_ITEM_WORDS`` is refused. Documents are not shuffled.

Defined results: null or empty texts have no words and no hits; null or empty items have no
windows; repeated items count by their distinct ids (a null id is the empty id); an empty
benchmark gives no hits; other columns of the documents are kept by ``decontaminate``.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from turnloom.llm.common import ship, table

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_WORDS = 1_000_000
MAX_ITEM_WORDS = 20_000_000

# Letters are lower-cased; other ASCII characters than letters and digits separate words.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
WORD_BYTES = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class Automaton:
    """Suffix automaton of many word sequences."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.length, self.link, self.next = [0], [-1], [{}]
        ends: dict[int, set[str]] = {}
        whole: dict[int, set[str]] = {}
        self.shortest = window
        for item, words in items:
            if not words:
                continue
            state = 0
            for word in words:
                state = self._extend(state, self.vocab.setdefault(word, len(self.vocab)))
                if self.length[state] >= window:
                    ends.setdefault(state, set()).add(item)
            if len(words) < window:
                whole.setdefault(state, set()).add(item)
                self.shortest = min(self.shortest, len(words))
        self._finish(ends, whole)

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        state = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            other = self.next[at][word]
            fits = self.length[other] == self.length[at] + 1
            self.link[state] = other if fits else self._split(at, word, other)
        return state

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.length.append(length)
        self.next.append(edges)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, at: int, word: int, old: int) -> int:
        new = self._state(self.length[at] + 1, dict(self.next[old]), self.link[old])
        self.link[old] = new
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = new
            at = self.link[at]
        return new

    def _finish(self, ends: dict[int, set[str]], whole: dict[int, set[str]]) -> None:
        """Items of each window state, and the short items that end in each state."""
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for state in reversed(order):
            up = self.link[state]
            if state in ends and self.length[up] >= self.window:
                ends.setdefault(up, set()).update(ends[state])
        # From every state to the one on its suffix path that holds the last `window` words.
        self.top = list(range(len(self.length)))
        self.short: list[tuple] = [()] * len(self.length)
        for state in order:
            up = self.link[state]
            if self.length[up] >= self.window:
                self.top[state] = self.top[up]
            own = ((self.length[state], frozenset(whole[state])),) if state in whole else ()
            self.short[state] = self.short[up] + own
        self.items = {
            s: frozenset(ends[s]) for s in ends if self.length[self.link[s]] < self.window
        }

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (start, end), in order of their ends, and the items with windows."""
        get = self.vocab.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], ids >= 0, [0]])))
        starts, stops = edge[::2], edge[1::2]
        long_enough = stops - starts >= self.shortest
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        length, link, edges = self.length, self.link, self.next
        for start, stop in zip(starts[long_enough].tolist(), stops[long_enough].tolist()):
            state = matched = 0
            for i, word in enumerate(ids[start:stop].tolist(), start + 1):
                while state and word not in edges[state]:
                    state = link[state]
                    matched = length[state]
                if word in edges[state]:
                    state = edges[state][word]
                    matched += 1
                if matched >= self.window:
                    found |= self.items[self.top[state]]
                    spans.append((i - self.window, i))
                for m, items in self.short[state]:
                    if m <= matched:
                        found |= items
                        spans.append((i - m, i))
        return spans, found


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Overlapping or touching spans joined."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def without(text: str, spans: list[list[int]]) -> str:
    """``text`` without the bytes from the first to the last word of each span."""
    raw = text.encode()
    places = [m.span() for m in WORD_BYTES.finditer(raw.translate(FOLD))]
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def automata(items: DataFrame, window: int) -> list[bytes]:
    """Pickled automata over blocks of items; the items' words are counted first."""
    clean = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"
    ).filter("text is not null")
    total = clean.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    if total > MAX_ITEM_WORDS:
        raise ValueError(f"{total} words of test items; at most {MAX_ITEM_WORDS} can be sent")
    blocks, block, size = [], [], 0
    for row in clean.toLocalIterator():
        words = words_of(row["text"])
        block.append((row["item_id"], words))
        size += len(words)
        if size >= BLOCK_WORDS:
            blocks.append(pickle.dumps(Automaton(block, window)))
            block, size = [], 0
    return [*blocks, pickle.dumps(Automaton(block, window))]


ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
]


def find_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, clean: bool = False
) -> DataFrame:
    """``docs`` with n_words, n_hit and hit_items; ``clean``: hit spans cut out of ``text``.

    Columns of those names in ``docs`` are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in {f.name for f in ADDED}]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    ship(spark)
    sent = spark.sparkContext.broadcast(automata(items, window))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = pickle.loads(sent.value[0]) if len(sent.value) == 1 else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans: list[list] = [[] for _ in texts]
            found: list[set] = [set() for _ in texts]
            counts = [0] * len(texts)
            for blob in sent.value:
                automaton = alone or pickle.loads(blob)
                for k, text in enumerate(texts):
                    words = words_of(text)
                    counts[k] = len(words)
                    own, ids = automaton.hits(words)
                    spans[k] += own
                    found[k] |= ids
            joined = [merged(s) for s in spans]
            columns = dict(zip(batch.schema.names, batch.columns))
            if clean:
                columns["text"] = pa.array(
                    [without(t, s) if s else t for t, s in zip(texts, joined)], pa.string()
                )
            columns["n_words"] = pa.array(counts, pa.int64())
            columns["n_hit"] = pa.array([sum(e - s for s, e in x) for x in joined], pa.int64())
            columns["hit_items"] = pa.array(
                [sorted(x) for x in found], pa.list_(pa.string())
            )
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(stream, T.StructType([*docs.schema.fields, *ADDED]))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
) -> DataFrame:
    """``docs`` without hit spans; documents whose hit words exceed ``max_coverage`` go.

    Same columns as ``docs``; an ``n_chars`` column is set to the length of the new text.
    """
    hit = find_hits(
        docs.withColumns({f"_doc_{f.name}": F.col(f.name) for f in ADDED if f.name in docs.columns}),
        items,
        window,
        clean=True,
    )
    kept = hit.filter(F.col("n_hit") <= F.col("n_words") * max_coverage)
    out = []
    for c in docs.columns:
        if c in {f.name for f in ADDED}:
            out.append(F.col(f"_doc_{c}").alias(c))
        elif c == "n_chars":
            new = F.length("text").cast(docs.schema[c].dataType)
            out.append(F.when(F.col("n_hit") > 0, new).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return kept.select(*out)


def op7_suffix_automaton(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = find_hits(docs, table(spark, sf_dir, "benchmark"))
    return hit.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
