"""Substring dedup: Relative Lempel-Ziv parsing of each document against all earlier ones.

The reference of a document is every document with a smaller doc_id. It is cut into
blocks by content: all windows of ``WINDOW`` words whose least hash of ``ANCHOR`` words (the
anchor) is the same belong to one block, so equal windows are in equal blocks wherever they
stand. Blocks are dealt to buckets by their anchor, and each bucket is an index: window to
the least document and place that has it. Documents are matched with the indexed blocks in
the same buckets; matches that go on in the same reference document at the following place
make a run. Finally each document is parsed greedily: a factor is the run that reaches
farthest from the current word, anything else is a literal. A factor may stop where its
reference document differs although another one goes on, so the windows that lie across factor
boundaries are looked up in the index as all others are.

Skew. Within a task, a window is sent once for the least document that has it; other
documents of the task are matched at once. So copies by the million send one window per
task. Where a passage has different surroundings everywhere, its block would hold a window
of each document; anchors found often in the first pass (at most ``HOT_ANCHORS``) therefore
do not decide the bucket, the window itself does. Buckets hold about ``BUCKET_WORDS``
windows, so there are more of them for more text.

Windows are compared by 64-bit hashes within a bucket, together with the bits of the bucket.

Defined results: null and empty texts have no words, and an empty string as kept text; rows
of one doc_id are taken as repeats of one document; a null doc_id has no place in the order:
its text is kept and is no reference; an empty table gives no rows; other columns are not
read by the query and are kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from turnloom.llm.common import ship, stored, table
from turnloom.llm.words import hash_words, mixed, run_hashes, slices, WORD_BASE

WINDOW = 50
ANCHOR = 16
BUCKET_WORDS = 1_000_000
LOCAL_HOT = 8  # an anchor with so many blocks in a slice of a task is counted
HOT_SHARE = 0.05  # of the blocks that a bucket holds on average
HOT_ANCHORS = 100_000

ENTRY = "bucket int, docs binary, starts binary, counts binary, hashes binary, refs binary, ref_starts binary"
RUN = "doc_id long, start long, n long, ref_doc long, ref_start long"


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :])


def blocks_of(texts: pa.Array, window: int) -> tuple[np.ndarray, ...]:
    """Hash, row, place and anchor of all windows of ``window`` words."""
    words = hash_words(texts)
    hashes, rows, places = words.windows(window)
    if not len(hashes):
        return hashes, rows, places, hashes
    size = min(ANCHOR, window)
    at = np.arange(len(words.hashes) - size + 1)
    grams = run_hashes(words.hashes, WORD_BASE, at, at + size)
    anchors = least(grams, window - size + 1)[words.at[rows] + places]
    return hashes, rows, places, mixed(anchors)


def breaks(*columns: tuple[np.ndarray, int]) -> np.ndarray:
    """Where a run begins: some column does not grow by its step."""
    n = len(columns[0][0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for values, step in columns:
        new[1:] |= values[1:] != values[:-1] + np.asarray(step, dtype=values.dtype)
    return np.flatnonzero(new)


def count_anchors(docs: DataFrame, window: int) -> DataFrame:
    """Anchors with many blocks, and in the row without an anchor the number of windows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for part in slices(batch):
                _, rows, places, anchors = blocks_of(part.column("text"), window)
                total += len(anchors)
                first = breaks((rows, 0), (anchors, 0))
                values, n = np.unique(anchors[first], return_counts=True)
                often = n >= LOCAL_HOT
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))],
                    ["anchor", "n"],
                )
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["anchor", "n"]
        )

    return docs.select("text").mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(
        F.sum("n").alias("n")
    )


def _entries(docs: DataFrame, window: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Blocks for the index, by bucket, and the matches found within a slice of a task."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)  # at most HOT_ANCHORS numbers

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, rows, places, anchors = blocks_of(part.column("text"), window)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[rows]
                order = np.lexsort((places, ids, hashes))
                first = breaks((hashes[order], 0))
                of = np.repeat(order[first], np.diff(np.append(first, len(order))))
                ref = np.empty(len(order), dtype=np.int64)
                ref[order] = of
                later = ids > ids[ref]
                yield from _local(ids, places, ref, later, buckets)
                keep = np.flatnonzero(~later)
                yield from _by_bucket(
                    ids[keep], places[keep], anchors[keep], hashes[keep], buckets, sent.value
                )

    return docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(cut, ENTRY)


def _local(ids, places, ref, later, buckets) -> Iterator[pa.RecordBatch]:
    mine = np.flatnonzero(later)
    if len(mine):
        docs, starts, refs, ref_starts = ids[mine], places[mine], ids[ref[mine]], places[ref[mine]]
        at = breaks((docs, 0), (starts, 1), (refs, 0), (ref_starts, 1))
        counts = np.diff(np.append(at, len(mine)))
        to = int(docs[0]) % buckets
        yield _batch([(to, docs[at], starts[at], counts, None, refs[at], ref_starts[at])])


def _by_bucket(ids, places, anchors, hashes, buckets, hot) -> Iterator[pa.RecordBatch]:
    key = np.where(np.isin(anchors, hot), mixed(hashes), anchors) if len(hot) else anchors
    to = ((key >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    to, ids, places, hashes = to[order], ids[order], places[order], hashes[order]
    at = breaks((to, 0), (ids, 0), (places, 1))
    counts = np.diff(np.append(at, len(ids)))
    edges = np.append(np.flatnonzero(np.append(True, np.diff(to[at]) != 0)), len(at)) if len(at) else [0]
    out = []
    for low, high in zip(edges[:-1], edges[1:]):
        run = slice(low, high)
        words = slice(at[low], at[high - 1] + counts[high - 1])
        out.append((int(to[at[low]]), ids[at[run]], places[at[run]], counts[run], hashes[words], None, None))
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (np.int64, np.uint32, np.uint32, np.uint64, np.int64, np.uint32)
    columns = [pa.array([r[0] for r in rows], pa.int32())]
    for k, kind in enumerate(kinds, 1):
        values = [None if r[k] is None else r[k].astype(kind).tobytes() for r in rows]
        columns.append(pa.array(values, pa.binary()))
    names = ["bucket", "docs", "starts", "counts", "hashes", "refs", "ref_starts"]
    return pa.RecordBatch.from_arrays(columns, names)


def _read(cells: list, kind) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=kind).astype(np.int64 if kind != np.uint64 else kind)


def _runs(docs, starts, refs, ref_starts) -> pa.Table:
    order = np.lexsort((starts, docs))
    docs, starts, refs, ref_starts = (x[order] for x in (docs, starts, refs, ref_starts))
    at = breaks((docs, 0), (starts, 1), (refs, 0), (ref_starts, 1))
    counts = np.diff(np.append(at, len(docs)))
    return _table(docs[at], starts[at], counts, refs[at], ref_starts[at])


def _table(*columns) -> pa.Table:
    names = ["doc_id", "start", "n", "ref_doc", "ref_start"]
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, columns)})


def match_bucket(rows: pa.Table) -> pa.Table:
    """Runs of windows of one bucket that an earlier document has, with where it has them."""
    local = rows.filter(rows.column("hashes").is_null())
    index = rows.filter(rows.column("hashes").is_valid())
    cells = {c: index.column(c).to_pylist() for c in ("docs", "starts", "counts", "hashes")}
    counts = _read(cells["counts"], np.uint32)
    docs = np.repeat(_read(cells["docs"], np.int64), counts)
    first = np.cumsum(counts) - counts
    places = np.repeat(_read(cells["starts"], np.uint32) - first, counts) + np.arange(len(docs))
    hashes = _read(cells["hashes"], np.uint64)
    order = np.lexsort((places, docs, hashes))
    at = breaks((hashes[order], 0))
    ref = np.repeat(order[at], np.diff(np.append(at, len(order))))
    later = docs[order] > docs[ref]
    order, ref = order[later], ref[later]
    found = [_runs(docs[order], places[order], docs[ref], places[ref])]
    if local.num_rows:
        kinds = {"docs": np.int64, "starts": np.uint32, "counts": np.uint32, "refs": np.int64, "ref_starts": np.uint32}
        found.append(_table(*[_read(local.column(c).to_pylist(), k) for c, k in kinds.items()]))
    return pa.concat_tables(found)


def find_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Runs (doc_id, start, n, ref_doc, ref_start): ``n`` consecutive windows that begin at
    word ``start`` and also begin at ``ref_start`` of a document with a smaller id."""
    ship(docs.sparkSession)
    counted = stored(count_anchors(docs, window), "anchors")
    windows = counted.filter("anchor is null").agg(F.sum("n")).first()[0] or 0
    buckets = max(12, windows // BUCKET_WORDS)
    # An anchor has about as many windows as the window has words outside it, halved.
    least_n = max(LOCAL_HOT, int(HOT_SHARE * windows / buckets / 18))
    hot = (
        counted.filter(F.col("anchor").isNotNull() & (F.col("n") >= least_n))
        .orderBy(F.desc("n"), "anchor")
        .limit(HOT_ANCHORS)
        .select("anchor")
    )
    hot = np.array([r[0] for r in hot.collect()], dtype=np.int64).view(np.uint64)
    entries = _entries(docs, window, buckets, hot)
    return entries.groupBy("bucket").applyInArrow(match_bucket, RUN)


def parse(runs: list, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, words, ref_doc, ref_start) of one document from its runs.

    From each word the run that reaches farthest is taken. Its part beyond the end of the
    factor before it is the new factor.
    """
    reach = sorted((r["start"], -(r["start"] + r["n"] + window - 1), r["ref_doc"], r["ref_start"]) for r in runs)
    factors, at, k = [], 0, 0
    while k < len(reach):
        at = max(at, reach[k][0])
        best = None
        while k < len(reach) and reach[k][0] <= at:
            if best is None or reach[k][1] < best[1]:
                best = reach[k]
            k += 1
        start, end, ref_doc, ref_start = best[0], -best[1], best[2], best[3]
        if end > at:
            factors.append((at, end - at, ref_doc, ref_start + at - start))
            at = end
    return factors


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_text (words joined by one space) and factors.

    Columns of these names in ``docs`` are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text", "factors", "_runs")
    runs = find_runs(docs, window).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "n", "ref_doc", "ref_start")).alias("_runs")
    )
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
        T.StructField(
            "factors",
            T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "n", "ref_doc", "ref_start")])),
        ),
    ]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "n", "ref_doc", "ref_start")]))

    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text, found in zip(
                    part.column("text").to_pylist(), part.column("_runs").to_pylist()
                ):
                    words = text.encode().split() if text else []
                    n, factors = len(words), parse(found, window) if found else []
                    for start, size, _, _ in reversed(factors):
                        del words[start : start + size]
                    rows.append((n, n - len(words), b" ".join(words).decode(), factors))
                columns = [part.column(c) for c in names]
                columns += [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
                factors = [[dict(zip(("start", "n", "ref_doc", "ref_start"), f)) for f in r[3]] for r in rows]
                columns.append(pa.array(factors, kind))
                yield pa.RecordBatch.from_arrays(columns, [*names, *(f.name for f in added)])

    joined = docs.join(runs, "doc_id", "left").select(*docs.columns, "_runs")
    return joined.mapInArrow(keep, T.StructType([*docs.schema.fields, *added]))


def op1_lempel_ziv(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )
