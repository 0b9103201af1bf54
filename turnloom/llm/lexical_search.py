"""Ranked lexical search over a length-stratified index.

A term is a run of letters, digits and non-ASCII characters, A-Z lower-cased. A document of n
terms has the normaliser m = 50 + (50 n N) div L, where N counts the documents with a term and L
all their terms. A term of an item weighs w = floor(1000 ln((2N + 2) / (2 df + 1))) and adds
w ((10^9 tf) div (1000 tf + 20 m)) to a document's score; the rest is 64-bit integer arithmetic.

Index: documents are laid out by m in parts of equal bytes (a histogram of bytes over m says where
each begins), so those of equal m (a stratum) lie together, and cut into blocks of one stratum of
at most ``BLOCK_BYTES``; a stratum of any size is spread over blocks and parts. A block holds its distinct terms (64-bit hashes), and each term's
postings by falling tf. Every document with a term is in one block.

Search, for a group of about ``ITEMS`` items at a time, against all blocks:

1. df of the items' terms is added up over the blocks, then terms are weighed.
2. The bound of a block for an item takes each of its terms at the block's highest tf. Each
   item visits the ``FIRST`` blocks of highest bound; its k-th score there is its threshold.
3. All blocks are visited, for the items whose bound reaches their threshold only. Within a block the
   impact of a tf is computed once, since m is the same; a task keeps k documents an item, and
   raises the threshold as it goes. Results are merged by salted windows.

Nothing is left out: a block is skipped only if no document in it can reach the k-th score.

Defined results: null, empty and term-less texts are not in the index and never found; a null
doc_id is found, after all others of the same score; each of repeated rows is found; ties go to
the smaller doc_id; rows of one item_id are one item (its terms once each); an item without
terms, or whose terms occur nowhere, has no rows; empty tables give no rows; a text longer than a
block is a block of its own; other columns are not read, so their names cannot clash. doc_id has
to be an integer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from turnloom.llm.common import ship, stored, table
from turnloom.llm.words import hash_words, slices

GAP = np.array([not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) for c in range(256)])
BLOCK_BYTES = 1_000_000
BLOCK_DOCS = 60_000
PARTITION_BYTES = 32_000_000
GROUP_BYTES = 8_000_000
ITEMS = 512
FIRST = 8
SALTS = 64
K = 50
NO_ID = np.iinfo(np.int64).max
EXACT = float(1 << 53)  # doubles hold whole numbers up to here

INDEX = "block long, m long, docs binary, terms binary, at binary, top binary, rows binary, tf binary"


def _block(number: int, m: int, docs: list, texts: pa.Array) -> pa.RecordBatch:
    words = hash_words(texts, lower=True, space=GAP)
    of = np.repeat(np.arange(len(docs)), np.diff(words.at))
    terms, term = np.unique(words.hashes, return_inverse=True)
    pairs, tf = np.unique(term * len(docs) + of, return_counts=True)
    term, doc = pairs // len(docs), pairs % len(docs)
    order = np.lexsort((doc, -tf, term))
    at = np.searchsorted(term, np.arange(len(terms) + 1))
    tf = tf[order]
    cells = [
        np.array([NO_ID if d is None else d for d in docs], dtype=np.int64),
        terms,
        at.astype(np.uint32),
        tf[at[:-1]].astype(np.uint32),
        doc[order].astype(np.uint16),
        np.minimum(tf, 255).astype(np.uint8),
    ]
    # Of frequencies above 254 the full number follows.
    large = tf[tf >= 255].astype("<u4").tobytes()
    data = [x.tobytes() for x in cells]
    data[-1] += large
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([m]), *[pa.array([x], pa.binary()) for x in data]],
        ["block", "m", "docs", "terms", "at", "top", "rows", "tf"],
    )


def _runs(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of a sorted array and where it stands, at most 10,000 places at a time."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    cuts = np.union1d(np.concatenate([[0], cuts, [len(values)]]), np.arange(0, len(values), 10_000))
    for a, b in zip(cuts[:-1].astype(int).tolist(), cuts[1:].astype(int).tolist()):
        yield int(values[a]), slice(a, b)


def _cut(block_bytes: int):
    """Blocks of consecutive documents of equal m."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        m, parts, size, count = None, [], 0, 0

        def joined() -> pa.RecordBatch:
            docs = [d for p in parts for d in p.column("doc_id").to_pylist()]
            texts = pa.concat_arrays([p.column("text").cast(pa.large_string()) for p in parts])
            return _block(task + made, m, docs, texts)

        for batch in batches:
            for piece in slices(batch):
                for own, at in _runs(piece.column("m").to_numpy()):
                    if parts and (own != m or size >= block_bytes or count >= BLOCK_DOCS - 10_000):
                        yield joined()
                        made, parts, size, count = made + 1, [], 0, 0
                    m = own
                    part = piece.slice(at.start, at.stop - at.start)
                    parts.append(part)
                    size += pc.sum(pc.binary_length(part.column("text"))).as_py()
                    count += part.num_rows
        if parts:
            yield joined()

    return cut


def _counts(texts: pa.Array) -> np.ndarray:
    """Number of terms of each text."""
    return np.diff(hash_words(texts, lower=True, space=GAP).at)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            text = part.column("text")
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(_counts(text).astype(np.int64)), size], ["n", "size"])


def _with_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            n = pa.array(_counts(part.column("text")).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns, n], ["doc_id", "text", "n"])


@dataclass
class Index:
    blocks: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> Index:
    """The stored index of all rows of ``docs`` (doc_id, text) that have a term."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = rows.select("text").mapInArrow(_sizes, "n long, size long").filter("n > 0")
    known = sizes.agg(
        F.count("*").alias("docs"), F.sum("n").alias("terms"), F.sum("size").alias("size")
    ).first()
    n_docs, n_terms = known["docs"], known["terms"] or 0
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L")
    far = 4096 + F.floor(64 * F.log2(F.col("m") / 4096))
    kind = F.when(F.col("m") < 4096, F.col("m")).otherwise(far)
    # At most some 8,000 kinds of m, with their bytes: where each begins in order of m.
    bytes_of = (
        sizes.withColumn("m", m).groupBy(kind.alias("kind")).agg(F.sum("size").cast("double").alias("bytes"))
    )
    upto = F.sum("bytes").over(W.orderBy("kind"))
    spans = F.broadcast(bytes_of.select("kind", "bytes", (upto - F.col("bytes")).alias("before")))
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    part = F.floor((F.col("before") + share * F.col("bytes")) / PARTITION_BYTES)
    placed = (
        rows.mapInArrow(_with_sizes, "doc_id long, text string, n long")
        .filter("n > 0")
        .select(m.alias("m"), "doc_id", "text")
        .withColumn("kind", kind)
        .join(spans, "kind")
        .select("m", "doc_id", "text", part.alias("part"))
        .repartitionById(max(12, (known["size"] or 0) // PARTITION_BYTES + 1), F.col("part").cast("int"))
        .sortWithinPartitions("part", "m", "doc_id")
        .select("m", "doc_id", "text")
    )
    return Index(stored(placed.mapInArrow(_cut(block_bytes), INDEX), "index", GROUP_BYTES), n_docs, n_terms)


class Block:
    """A row of the index."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda c, kind: np.frombuffer(batch.column(c)[row].as_py(), kind)
        self.id, self.m = batch.column("block")[row].as_py(), batch.column("m")[row].as_py()
        self.terms, self.at, self.top = get("terms", np.uint64), get("at", np.uint32), get("top", np.uint32)
        self._get = get

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sorted ``terms`` the block has, and where."""
        where = np.searchsorted(self.terms, terms)
        found = np.flatnonzero(self.terms[np.minimum(where, len(self.terms) - 1)] == terms)
        return found, where[found]

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        docs, rows = self._get("docs", np.int64), self._get("rows", np.uint16)
        data = self._get("tf", np.uint8)
        tf = data[: len(rows)].astype(np.int64)
        tf[tf == 255] = np.frombuffer(data[len(rows) :].tobytes(), "<u4")
        return docs, rows, tf

    def impact(self, tf: np.ndarray) -> np.ndarray:
        """The part of the score that depends on tf and m, once for each tf."""
        known, of = np.unique(tf, return_inverse=True)
        known = known.astype(np.int64)
        return ((1_000_000_000 * known) // (1000 * known + 20 * self.m))[of]


@dataclass
class Queries:
    """Items as rows of a 0/1 matrix over their distinct terms, and what is known of them."""

    ids: list
    terms: np.ndarray
    has: np.ndarray  # items x terms
    weight: np.ndarray | None = None
    least: np.ndarray | None = None  # thresholds

    kind: type = np.int64  # of products

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Weights; doubles, through fast products, are used where they are exact."""
        weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        self.weight = np.where(df > 0, weight, 0)
        most = 1e6 * float((self.has.astype(np.float64) @ self.weight).max(initial=0))
        self.kind = np.float64 if most < EXACT else np.int64

    def bounds(self, block: Block, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, where = block.find(self.terms)
        most = (self.weight[found] * block.impact(block.top[where])).astype(kind)
        return self.has[:, found].astype(kind) @ most, found, where

    def scores(self, block: Block, items: np.ndarray, found, where, kind) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block, and the scores (items x documents)."""
        docs, rows, tf = block.postings()
        low, high = block.at[where].astype(np.int64), block.at[where + 1].astype(np.int64)
        sizes = high - low
        at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        term = np.repeat(np.arange(len(found)), sizes)
        value = self.weight[found][term] * block.impact(tf[at])
        has = self.has[np.ix_(items, found)].astype(kind)
        out = np.zeros((len(items), len(docs)), dtype=kind)
        step = max(1, 4_000_000 // max(len(found), 1))  # documents at once
        order = np.argsort(rows[at], kind="stable")
        doc = rows[at][order].astype(np.int64)
        for first in range(0, len(docs), step):
            part = order[np.searchsorted(doc, first) : np.searchsorted(doc, first + step)]
            dense = np.zeros((len(found), min(step, len(docs) - first)), dtype=kind)
            dense[term[part], rows[at][part].astype(np.int64) - first] = value[part]
            out[:, first : first + step] = has @ dense
        return docs, out.astype(np.int64)


class Best:
    """The k best documents of each item so far."""

    def __init__(self, n: int, k: int):
        self.k, self.found = k, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n

    def add(self, item: int, docs: np.ndarray, scores: np.ndarray) -> int | None:
        """Returns the k-th score if there are k."""
        docs = np.concatenate([self.found[item][0], docs])
        scores = np.concatenate([self.found[item][1], scores])
        order = np.lexsort((docs, -scores))[: self.k]
        self.found[item] = (docs[order], scores[order])
        return int(scores[order[-1]]) if len(order) == self.k else None

    def rows(self, ids_of: int) -> pa.RecordBatch:
        sizes = [len(d) for d, _ in self.found]
        item = np.repeat(np.arange(len(self.found)), sizes)
        docs, scores = (np.concatenate([x[k] for x in self.found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        part = np.full(len(item), ids_of % SALTS, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (item, docs, scores, part)], ["item", "doc_id", "score", "part"]
        )


FOUND = "item long, doc_id long, score long, part long"


def _count_df(sent):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value.terms
        df = np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                found, where = block.find(terms)
                df[found] += (block.at[where + 1] - block.at[where]).astype(np.int64)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen])], ["term", "df"])

    return count


def _best_blocks(sent):
    """The FIRST blocks of highest bound of each item, of those of a task."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        best, kind = Best(len(queries.ids), FIRST), queries.kind
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                bound = queries.bounds(block, kind)[0].astype(np.int64)
                for item in np.flatnonzero(bound).tolist():
                    best.add(item, np.array([block.id]), bound[item : item + 1])
        yield best.rows(TaskContext.get().partitionId())

    return find


def _visit(sent, k: int):
    """The k best documents of each item in the blocks of a task."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        best, kind, least = Best(len(queries.ids), k), queries.kind, queries.least.copy()
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                bound, found, where = queries.bounds(block, kind)
                items = np.flatnonzero((bound > 0) & (bound >= least))
                if not len(items):
                    continue
                docs, scores = queries.scores(block, items, found, where, kind)
                for item, own in zip(items.tolist(), scores):
                    good = np.flatnonzero((own > 0) & (own >= least[item]))
                    if len(good):
                        last = best.add(item, docs[good], own[good])
                        least[item] = max(least[item], last or 0)
        yield best.rows(TaskContext.get().partitionId())

    return visit


def _top(found: DataFrame, k: int) -> DataFrame:
    """item, rank, doc_id, score of the k best of each item, over tasks in two steps."""
    order = [F.desc("score"), F.asc("doc_id")]
    for keys in (["item", "part"], ["item"]):
        nth = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", nth).filter(F.col("rank") <= k)
    return found.select("item", "rank", "doc_id", "score")


def _items(queries: DataFrame) -> DataFrame:
    """item_id and the distinct term hashes of each item, in groups of about ITEMS."""
    rows = queries.groupBy("item_id").agg(F.concat_ws(" ", F.collect_list("text")).alias("text"))
    kind = rows.schema["item_id"].dataType

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = hash_words(batch.column("text"), lower=True, space=GAP)
            cells = [
                np.unique(words.hashes[a:b]).tobytes() for a, b in zip(words.at[:-1], words.at[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(cells, pa.binary())], ["item_id", "terms"]
            )

    return rows.mapInArrow(parse, f"item_id {kind.simpleString()}, terms binary").filter("length(terms) > 0")


def search(index: Index, queries: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0."""
    spark = queries.sparkSession
    ship(spark)
    items = stored(_items(queries), "items")
    groups = -(-items.count() // ITEMS)
    group = F.pmod(F.xxhash64("item_id"), F.lit(max(groups, 1)))
    done = None
    for g in range(groups):
        # About ITEMS items a group: what is broadcast does not grow with the number of items.
        found = _search_group(index, items.filter(group == g).orderBy("item_id").toArrow(), k, spark)
        done = found if done is None else done.unionByName(found)
    id_type = queries.schema["item_id"].dataType.simpleString()
    if done is None:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    no_id = F.col("doc_id") == F.lit(int(NO_ID))
    return done.withColumn("doc_id", F.when(~no_id, F.col("doc_id"))).select(
        F.col("item_id").cast(id_type), F.col("rank").cast("int"), "doc_id", "score"
    )


def _search_group(index: Index, items: pa.Table, k: int, spark) -> DataFrame:
    ids = items.column("item_id").to_pylist()
    cells = [np.frombuffer(x, np.uint64) for x in items.column("terms").to_pylist()]
    terms, of = np.unique(np.concatenate([*cells, np.zeros(0, np.uint64)]), return_inverse=True)
    has = np.zeros((len(ids), len(terms)), dtype=bool)
    has[np.repeat(np.arange(len(ids)), [len(c) for c in cells]), of] = True
    queries = Queries(ids, terms, has)

    def sent():
        return spark.sparkContext.broadcast(queries)

    narrow = index.blocks.select("block", "m", "terms", "at", "top")
    counted = narrow.mapInArrow(_count_df(sent()), "term long, df long")
    df = counted.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    n = np.zeros(len(terms))
    n[df.column("term").to_numpy()] = df.column("df").to_numpy()
    queries.weigh(n, index.n_docs)
    queries.least = np.zeros(len(ids), dtype=np.int64)
    first = _top(narrow.mapInArrow(_best_blocks(sent()), FOUND), FIRST)
    chosen = sorted({r["doc_id"] for r in first.select("doc_id").distinct().collect()})
    if len(chosen):
        some = index.blocks.filter(F.col("block").isin(chosen))  # at most FIRST blocks an item
        seen = _top(some.mapInArrow(_visit(sent(), k), FOUND), k).filter(F.col("rank") == k)
        for r in seen.select("item", "score").collect():
            queries.least[r["item"]] = r["score"]
    found = _top(index.blocks.mapInArrow(_visit(sent(), k), FOUND), k)
    names = spark.createDataFrame(
        pa.table({"item": pa.array(np.arange(len(ids))), "item_id": items.column("item_id")})
    )
    return found.join(F.broadcast(names), "item").drop("item")


def op13_stratified_search(spark, sf_dir):
    index = build_index(table(spark, sf_dir, "documents"))
    return search(index, table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH terms AS (
  SELECT doc_id, row_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS row_id FROM documents)
),
tfs AS (SELECT doc_id, row_id, term, count(*) AS tf FROM terms GROUP BY ALL),
lens AS (SELECT row_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY row_id),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM lens),
norms AS (SELECT row_id, 50 + (50 * n * big_n) // big_l AS m FROM lens, total),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, total GROUP BY term, big_n
),
scored AS (
  SELECT item_id, doc_id, row_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (row_id)
  GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, row_id) AS nth
  FROM scored WHERE score > 0
)
SELECT item_id, nth::INTEGER AS rank, doc_id, score FROM ranked WHERE nth <= 50
"""
