"""N-gram Jaccard join: grouped prefix join over the sets of word shingles of documents.

Two documents link if the Jaccard similarity of their sets is at least ``threshold`` percent.
Shingles are ordered from rare to frequent; documents that link share a shingle among the
first ``n - ceil(t n) + 1`` of each (the prefix).

1. Documents of which fewer than t n shingles occur in any other document have a prefix of
   shingles of their own, so they link with nothing and leave here. Shingles are counted in
   buckets of 32-bit hashes; a collision can only keep a document. Within a task a shingle
   is sent once, as the property of one document or as a shared one.
2. Documents with the same set are one from here on (a 128-bit sum of the set's hashes). The
   sets of those left are ordered by frequency among them.
3. Documents with the same prefix and size are a group; prefixes are indexed by group.
4. Candidates of the first round are stars: each member with the first of its group, each
   group with the least special group of a shingle. Verified links give components.
5. Candidates of the second round are the pairs of groups that share a prefix shingle, pass
   the size and position filters, and lie in different components (members of the most
   frequent component of a shingle are not paired with each other). They are expanded to
   members, filtered by the parity signatures of the sets, and verified. Pairs within a
   component are not needed: their link would not change it.

So a group of a million near copies costs a star, not all pairs, and no link between
components is lost. Verification compares whole sets.

Defined results: texts without words have an empty set and link with nothing (their component
is themselves); a null doc_id has no component (null); rows of one doc_id are taken as
repeats of one document and all are returned; an empty table gives no rows; other columns
are not read by ``link_documents`` and are kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnloom.llm.common import ship, stored, table
from turnloom.llm.components import components
from turnloom.llm.substring_dedup import breaks
from turnloom.llm.words import hash_words, mixed, slices

SHINGLE = 4
THRESHOLD = 85
BUCKET_SHINGLES = 2_000_000
SIGNATURE = 16  # longs
FILTER_BITS = 1 << 26

ENTRY = "bucket int, docs binary, counts binary, shingles binary, marks binary, info binary"
SHARED = "doc_id long, m long, n long, k1 long, k2 long, n_rows long"


def sets_of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, sorted by row and hash."""
    words = hash_words(texts, lower=True)
    hashes, rows, _ = words.windows(size)
    sizes = np.diff(words.at)
    few = np.flatnonzero((sizes > 0) & (sizes < size))
    if len(few):
        # Another length is another shingle.
        whole = [mixed(words.whole(r) + np.uint64(sizes[r])) for r in few.tolist()]
        hashes, rows = np.concatenate([hashes, *whole]), np.concatenate([rows, few])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    first = breaks((rows, 0), (hashes, 0))
    return rows[first], hashes[first]


def _per_row(values: np.ndarray, rows: np.ndarray, n: int, how) -> np.ndarray:
    """Reduction of ``values`` over sorted ``rows``; 0 for rows without a value."""
    out = np.zeros(n, dtype=values.dtype)
    at = breaks((rows, 0))
    if len(at):
        out[rows[at]] = how.reduceat(values, at)
    return out


def _cut(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                rows, hashes = sets_of(part.column("text"), size)
                order = np.argsort(hashes, kind="stable")
                at = breaks((hashes[order], 0))
                counts = np.diff(np.append(at, len(order)))
                again = np.zeros(len(rows), dtype=np.int64)
                again[order] = np.repeat(counts > 1, counts)
                info = np.stack(
                    [
                        ids,
                        _per_row(again, rows, len(ids), np.add),
                        np.bincount(rows, minlength=len(ids)),
                        _per_row(mixed(hashes), rows, len(ids), np.add).view(np.int64),
                        _per_row(mixed(hashes + np.uint64(1)), rows, len(ids), np.add).view(np.int64),
                    ]
                )
                yield from _blobs(ids, rows, hashes, again == 0, hashes[order[at[counts > 1]]], info, buckets)

    return docs.mapInArrow(cut, ENTRY)


def _blobs(ids, rows, hashes, own, marks, info, buckets) -> Iterator[pa.RecordBatch]:
    to_own = ((hashes[own] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to_own, kind="stable")
    to_own, of, own = to_own[order], ids[rows[own]][order], hashes[own][order].astype(np.uint32)
    to_mark = ((marks >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to_mark, kind="stable")
    to_mark, marks = to_mark[order], marks[order].astype(np.uint32)
    out = []
    hit = np.union1d(to_own, to_mark)  # only buckets that this slice has something for
    own_at = np.stack([np.searchsorted(to_own, hit), np.searchsorted(to_own, hit, "right")])
    mark_at = np.stack([np.searchsorted(to_mark, hit), np.searchsorted(to_mark, hit, "right")])
    for k, b in enumerate(hit.tolist()):
        part = slice(own_at[0, k], own_at[1, k])
        at = breaks((of[part], 0)) if part.start < part.stop else np.zeros(0, np.int64)
        counts = np.diff(np.append(at, part.stop - part.start)).astype(np.uint32)
        out.append(
            (b, of[part][at].tobytes(), counts.tobytes(), own[part].tobytes(), marks[mark_at[0, k] : mark_at[1, k]].tobytes(), None)
        )
    out.append((int(info[0, 0]) % buckets, None, None, None, None, info.tobytes()))
    kinds = [pa.int32(), *[pa.binary()] * 5]
    names = ["bucket", "docs", "counts", "shingles", "marks", "info"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names
    )


def count_shared(groups: int):
    """How many shingles of one bucket each document shares, for each group of documents;
    what tasks said of documents is passed on."""

    def count(rows: pa.Table) -> pa.Table:
        info = _info(rows)
        index = rows.filter(rows.column("docs").is_valid())
        of = np.repeat(_cells(index, "docs", np.int64), _cells(index, "counts", np.uint32))
        shingles, marks = _cells(index, "shingles", np.uint32), _cells(index, "marks", np.uint32)
        every = np.concatenate([shingles, marks, marks])  # a mark stands for at least two
        order = np.argsort(every, kind="stable")
        at = breaks((every[order], 0))
        counts = np.diff(np.append(at, len(order)))
        shared = np.zeros(len(every), dtype=bool)
        shared[order] = np.repeat(counts > 1, counts)
        ids, m = np.unique(of[shared[: len(of)]], return_counts=True)
        group, told = (
            (mixed(x.astype(np.uint64)) % np.uint64(groups)).astype(np.int64) for x in (ids, info[0])
        )
        order, order_told = np.argsort(group, kind="stable"), np.argsort(told, kind="stable")
        group, ids, m = group[order], ids[order], m[order]
        told, info = told[order_told], info[:, order_told]
        hit = np.union1d(group, told)
        cuts = [np.searchsorted(x, hit, side) for x in (group, told) for side in ("left", "right")]
        out = [
            (g, ids[a:b].tobytes(), m[a:b].tobytes(), info[:, c:d].tobytes())
            for g, a, b, c, d in zip(hit.tolist(), *cuts)
        ]
        names, kinds = ["part", "docs", "m", "info"], [pa.int32(), *[pa.binary()] * 3]
        return pa.table({c: pa.array([r[k] for r in out], t) for k, (c, t) in enumerate(zip(names, kinds))})

    return count


def _cells(rows: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(column).to_pylist()), dtype=kind)


def _info(rows: pa.Table) -> np.ndarray:
    found = [np.frombuffer(x, np.int64).reshape(5, -1) for x in rows.column("info").to_pylist() if x]
    return np.concatenate(found, axis=1) if found else np.zeros((5, 0), np.int64)


def add_up(rows: pa.Table) -> pa.Table:
    """One row per document of a group: sums over buckets and tasks."""
    info = _info(rows)
    ids, first = np.unique(np.concatenate([info[0], _cells(rows, "docs", np.int64)]), return_inverse=True)
    told = first[: info.shape[1]]
    m = np.bincount(first, np.concatenate([info[1], _cells(rows, "m", np.int64)]), len(ids))
    most = np.full((3, len(ids)), np.iinfo(np.int64).min)
    for row, values in zip(most, info[2:]):
        np.maximum.at(row, told, values)
    columns = [ids, m.astype(np.int64), *most, np.bincount(told, minlength=len(ids))]
    names = ["doc_id", "m", "n", "k1", "k2", "n_rows"]
    return pa.table({c: pa.array(x.astype(np.int64)) for c, x in zip(names, columns)})


def survey(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n, k1, k2, m, n_rows) of each document: set size, set key, shared shingles.

    Counts go from buckets of shingles to groups of documents in blocks, not as rows.
    """
    ship(docs.sparkSession)
    docs = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(12, chars // 6 // BUCKET_SHINGLES)  # about six bytes a word
    counted = _cut(docs, size, buckets).groupBy("bucket").applyInArrow(
        count_shared(buckets), "part int, docs binary, m binary, info binary"
    )
    return counted.groupBy("part").applyInArrow(add_up, SHARED)


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bits of hashed ids: FILTER_BITS of them, whatever the number of ids."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ids.select(
        F.shiftright(place, 6).alias("word"),
        F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {FILTER_BITS}) & 63 as int))").alias("bit"),
    )
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, shingles array, s0..) of the documents of ``wanted`` (doc_id).

    A filter of fixed size stops most other texts in the scan; the join is exact.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(id_filter(wanted))  # FILTER_BITS / 8 bytes
    names = ["doc_id", "n", "shingles", *(f"s{k}" for k in range(SIGNATURE))]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("_place").to_numpy()
            hit = (bits.value[places >> 6] >> (places & 63)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            for part in slices(batch):
                rows, hashes = sets_of(part.column("text"), size)
                n = np.bincount(rows, minlength=part.num_rows)
                width = 64 * SIGNATURE
                at = rows * width + (mixed(hashes) >> np.uint64(40)).astype(np.int64) % width
                odd = (np.bincount(at, minlength=part.num_rows * width) & 1).astype(np.uint8)
                signs = np.packbits(odd).view(np.int64).reshape(part.num_rows, SIGNATURE)
                offsets = pa.array(np.append(0, np.cumsum(n)).astype(np.int32))
                shingles = pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n.astype(np.int64)), shingles, *(pa.array(s) for s in signs.T.copy())],
                    names,
                )

    columns = ", ".join(f"s{k} long" for k in range(SIGNATURE))
    rows = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long"), "text", F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER_BITS)).alias("_place")
    )
    built = rows.mapInArrow(build, f"doc_id long, n long, shingles array<long>, {columns}")
    return built.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])


def least_overlap(x: Column, y: Column, threshold: int) -> Column:
    return F.ceil((x + y) * threshold / (100 + threshold))


def _close(a: str, b: str, threshold: int) -> Column:
    """Sizes fit, and the signatures differ in no more bits than the sets may in shingles."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum(
        (F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(SIGNATURE)),
        F.lit(0),
    )
    sizes = F.least(x, y) * 100 >= F.greatest(x, y) * threshold
    return sizes & (differ <= x + y - 2 * least_overlap(x, y, threshold))


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets; signatures are compared first."""
    signs = sets.drop("shingles")
    near = (
        pairs.join(signs.alias("x"), F.col("a") == F.col("x.doc_id"))
        .join(signs.alias("y"), F.col("b") == F.col("y.doc_id"))
        .filter(_close("x", "y", threshold))
        .select("a", "b")
    )
    whole = sets.select("doc_id", "shingles")
    both = (
        stored(near, "pairs").join(whole.alias("x"), F.col("a") == F.col("x.doc_id"))
        .join(whole.alias("y"), F.col("b") == F.col("y.doc_id"))
        .select("a", "b", F.col("x.shingles").alias("x"), F.col("y.shingles").alias("y"))
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for k in range(batch.num_rows):
                x, y = (batch.column(c)[k].values.to_numpy() for c in ("x", "y"))
                same = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * same >= threshold * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def prefixes(sets: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, n, own, prefix, group): shared prefix shingles, rare ones first.

    ``own`` shingles occur nowhere else and come before them. Documents without shared
    prefix shingles link with nothing and are left out.
    """
    shingles = sets.select("doc_id", "n", F.explode("shingles").alias("shingle"))
    often = shingles.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    shared = (
        shingles.join(often, "shingle")
        .groupBy("doc_id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
    )
    length = F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1
    cut = (length - F.col("own")).cast("int")
    return (
        shared.withColumn("own", F.col("n") - F.size("shared"))
        .filter(cut > 0)
        .select("doc_id", "n", "own", F.slice(F.transform("shared", lambda s: s["shingle"]), F.lit(1), cut).alias("prefix"))
        # Shingles of one's own belong to the prefix: such a document is a group alone.
        .withColumn("group", F.xxhash64("n", "prefix", F.when(F.col("own") > 0, F.col("doc_id"))))
    )


def link(sets: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) that connect all components of the documents in ``sets``."""
    members = stored(prefixes(sets, threshold), "prefixes")
    groups = members.groupBy("group").agg(
        F.min("doc_id").alias("head"),
        F.first("n").alias("n"),
        F.first("own").alias("own"),
        F.first("prefix").alias("prefix"),
    )
    index = stored(
        groups.select("group", "head", "n", "own", F.posexplode("prefix").alias("place", "shingle")), "index"
    )
    # First round: stars.
    center = index.groupBy("shingle").agg(F.min(F.struct("own", "n", "head"))["head"].alias("center"))
    stars = members.join(groups.select("group", "head"), "group").select(
        F.col("head").alias("a"), F.col("doc_id").alias("b")
    ).unionByName(index.join(center, "shingle").select(F.col("center").alias("a"), F.col("head").alias("b")))
    first = stored(verified(stars.filter("a != b").distinct(), sets, threshold), "links")
    # Second round: between components.
    labels = components(first)
    labelled = members.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "group", "n", "own", "prefix", F.coalesce("component", "doc_id").alias("component")
    )
    labelled = stored(labelled, "labelled")
    cells = stored(
        labelled.groupBy("group", "component").agg(
            F.count("*").alias("size"),
            F.min("doc_id").alias("head"),
            F.first("n").alias("n"),
            F.first("own").alias("own"),
            F.first("prefix").alias("prefix"),
        ),
        "cells",
    )
    places = cells.select(
        "group", "component", "size", "head", "n", "own", F.posexplode("prefix").alias("place", "shingle")
    )
    per = places.groupBy("shingle", "component").agg(F.count("*").alias("cells"))
    main = per.groupBy("shingle").agg(
        F.max(F.struct("cells", "component"))["component"].alias("main"), F.count("*").alias("parts")
    )
    mixed_ones = places.join(main.filter("parts > 1"), "shingle")
    signs = sets.drop("shingles", "n").withColumnRenamed("doc_id", "head")
    posted = stored(mixed_ones.join(signs, "head"), "posted")
    x, y = posted.filter("component != main").alias("x"), posted.alias("y")
    left = F.least(*[F.col(f"{s}.n") - F.col(f"{s}.own") - F.col(f"{s}.place") - 1 for s in "xy"])
    apart = (
        (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("y.main")) | (F.col("x.component") < F.col("y.component")))
        & (1 + left >= least_overlap(F.col("x.n"), F.col("y.n"), threshold))
        & ((F.col("x.size") > 1) | (F.col("y.size") > 1) | _close("x", "y", threshold))
    )
    names = [F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("group", "component")]
    near = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & apart).select(*names).distinct()
    whole = labelled.select("doc_id", "group", "component", "n").join(sets.drop("shingles", "n"), "doc_id")
    pairs = (
        near.join(whole.select(F.col("group").alias("x_group"), F.col("component").alias("x_component"), F.col("doc_id").alias("a")), ["x_group", "x_component"])
        .join(whole.select(F.col("group").alias("y_group"), F.col("component").alias("y_component"), F.col("doc_id").alias("b")), ["y_group", "y_component"])
        .select("a", "b")
        .distinct()
    )
    return first.unionByName(verified(pairs, sets, threshold))


def link_documents(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text)."""
    seen = stored(survey(docs, size), "survey")
    key = ["n", "k1", "k2"]
    same = seen.filter("n > 0").groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("m").alias("m"))
    left = stored(same.filter(F.col("m") * 100 >= F.col("n") * threshold).select(F.col("first").alias("doc_id")), "left")
    sets = stored(full_sets(docs, left, size), "sets")
    found = components(link(sets, threshold)).withColumnRenamed("node", "first")
    first = same.select(*key, "first").join(found, "first", "left").select(
        *key, F.coalesce("component", "first").alias("component")
    )
    linked = seen.join(first, key, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.explode(F.sequence(F.lit(1), F.col("n_rows"))).alias("row"),
    )
    nameless = docs.filter("doc_id is null").select("text").mapInArrow(_sizes(size), "n_shingles long")
    return linked.drop("row").unionByName(
        nameless.select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id"))
    )


def _sizes(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows, _ = sets_of(part.column("text"), size)
                n = np.bincount(rows, minlength=part.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(n)], ["n_shingles"])

    return count


def keep_one(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each component: the one with the least doc_id.

    Rows with a null doc_id stay. Of repeated rows of a document one stays.
    """
    linked = link_documents(docs.select("doc_id", "text"), size, threshold)
    gone = linked.filter("component_id != doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    named = kept.filter("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(kept.filter("doc_id is null"))


def op9_grouped_prefix(spark, sf_dir):
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
