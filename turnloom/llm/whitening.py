"""Embedding whitening with eigenvectors refined from single to double precision.

Entries become integers x = floor(1024 c) + 100000. One pass adds up counts and sums per
dimension, a second one the covariance of the centred vectors (products in double
precision; one matrix a task, added up in ``PARTS`` groups, so the driver sees ``PARTS`` matrices
whatever the number of tasks). The covariance has the size of a vector squared, and its eigenvectors
are found on the driver:

1. A symmetric solver in float32 gives approximate eigenvectors.
2. Ogita-Aishima iterations correct all of them at once with matrix products in higher
   precision (extended doubles): X <- X + X E, where E follows from R = I - X'X and
   S = X'AX. They converge quadratically where eigenvalues are apart.
3. Eigenvalues too close for that form clusters. Within a cluster only orthogonality is refined; then a
   sub-solve of X'(A - mu I)X for its columns, whose entries are as small as the gaps, turns them into
   eigenvectors, and the iterations go on.

Whitened coordinates are the centred vector's projections, over the root of the eigenvalue.

Defined results: null vectors, and vectors with a null, a NaN, an infinite entry or one of at
least 2^40 in size, are dropped, and so are vectors whose length is not the most frequent one (the
longest of equally frequent ones). Components whose eigenvalue is not above rounding
(trace times dimension times 1e-13) are left out: equal vectors alone have none. Repeated rows
count as often as they occur; a null vec_id stays null; ties between eigenvalues are ordered by
the solver, the same for all rows; each component's largest entry is positive. ``deviation`` is null where the exact
sum exceeds a long; ``deviation_text`` always has it. An empty table gives no rows; other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from turnloom.llm.common import ship, stored, table

COMPONENTS = 8
PARTS = 64
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
ROUNDS = 20
SUB_SOLVES = 3
HIGH = np.longdouble


def usable(vectors: pa.Array, size: int | None = None) -> np.ndarray:
    """Which rows have a finite vector (of ``size`` entries)."""
    lengths = pa.compute.fill_null(pa.compute.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    good = lengths > 0 if size is None else lengths == size
    flat = vectors.flatten()
    values = np.asarray(pa.compute.fill_null(flat.cast(pa.float64()), float("nan")))
    bad = ~(np.abs(values) < LARGEST)
    owner = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
    good[owner[bad]] = False
    return good


def integers(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The x-vectors of the usable rows, and which rows those are."""
    good = usable(vectors, size)
    flat = vectors.filter(pa.array(good)).flatten().cast(pa.float64())
    values = np.asarray(flat).reshape(-1, size)
    return np.floor(values * SCALE).astype(np.int64) + SHIFT, np.flatnonzero(good)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    found = batch.column(name)
    return found.cast(pa.list_(found.type.value_type))


@dataclass
class Whitening:
    """Fitted on all vectors: count, sums, eigenvalues (falling) and their vectors (columns)."""

    size: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    most: int  # largest |n x - S| that may occur

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(HIGH(s) / HIGH(self.n)) for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        if self.most < 1 << 62:
            return (self.n * x - np.array(self.sums, dtype=np.int64)) / float(self.n)
        return ((x - np.array([s // self.n for s in self.sums])) - np.array([(s % self.n) / self.n for s in self.sums]))

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n x - S)^2, exact."""
        if self.size * self.most * self.most < 1 << 62:
            d = self.n * x - np.array(self.sums, dtype=np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return [int(v) for v in (d * d).sum(axis=1)] if len(d) else []


def refined(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its eigenvectors, to double precision."""
    high = (a.astype(HIGH) + a.T.astype(HIGH)) / 2
    scale = HIGH(np.abs(a).max(initial=0)) or HIGH(1)
    high = high / scale
    x = np.linalg.eigh(high.astype(np.float32))[1].astype(HIGH)
    for solve in range(SUB_SOLVES + 1):
        x, values, width = _iterated(high, x)
        groups = _clusters(values, width)
        if solve == SUB_SOLVES or not groups:
            break
        x = _sub_solved(high, x, values, groups)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(x))])
    return (values[order] * scale).astype(np.float64), x.astype(np.float64)


def _iterated(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Ogita-Aishima iterations until the correction no longer shrinks; also the width below
    which eigenvalues count as clustered."""
    least, stalled, eye = np.inf, 0, np.eye(len(a), dtype=HIGH)
    for _ in range(ROUNDS):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        width = 2 * float(np.linalg.norm(off.astype(np.float64)) + np.linalg.norm(r.astype(np.float64)))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > width
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        change = float(np.abs(e).max(initial=0))
        stalled = stalled + 1 if change > least / 2 and change < 1e-6 else 0
        least = min(least, change)
        if change < 1e-18 or stalled == 2:
            break
    for _ in range(4):  # what the last corrections left of orthogonality
        x = x + x @ ((eye - x.T @ x) / 2)
    return x, np.diag(x.T @ (a @ x)), max(width, 1e-17)


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Places of neighbouring eigenvalues that are no further apart than ``width``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def _sub_solved(a: np.ndarray, x: np.ndarray, values: np.ndarray, groups: list) -> np.ndarray:
    """Eigenvectors within each cluster, from the shifted matrix of its columns alone."""
    x = x.copy()
    for g in groups:
        part, mu = x[:, g], values[g].mean()
        small = part.T @ (a @ part) - mu * (part.T @ part)
        top = np.abs(small).max() or HIGH(1)
        small = ((small + small.T) / (2 * top)).astype(np.float64)
        x[:, g] = part @ np.linalg.eigh(small)[1].astype(HIGH)
    return x


def _sums(size: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        low, high = np.full(size, LARGEST * SCALE * 4), np.full(size, -LARGEST * SCALE * 4)
        for batch in batches:
            x, _ = integers(_column(batch, "vector"), size)
            if len(x):
                n += len(x)
                # Halves of 31 bits, so that no sum of a batch can overflow.
                up, down = (x >> 31).sum(axis=0).tolist(), (x & 0x7FFFFFFF).sum(axis=0).tolist()
                sums = [s + (u << 31) + d for s, u, d in zip(sums, up, down)]
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(size)),
                    pa.array(np.full(size, n)),
                    pa.array([s >> 31 for s in sums]),
                    pa.array([s & 0x7FFFFFFF for s in sums]),
                    pa.array(low.astype(np.int64)),
                    pa.array(high.astype(np.int64)),
                ],
                ["place", "n", "up", "down", "low", "high"],
            )

    return add


def _products(values, width: int):
    """One matrix a task: the sum of the outer products of ``values(batch)``, and of the rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            d = values(batch)
            total += d.T @ d
            rows += d.sum(axis=0)
        part = TaskContext.get().partitionId() % PARTS
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([np.vstack([total, rows]).tobytes()], pa.binary())],
            ["part", "sums"],
        )

    return add


def _added(rows: pa.Table) -> pa.Table:
    cells = np.zeros(1)
    for one in rows.column("sums").to_pylist():
        cells = cells + np.frombuffer(one)
    return pa.table({"part": rows.column("part").slice(0, 1), "sums": pa.array([cells.tobytes()], pa.binary())})


def _covariance(rows: DataFrame, values, width: int, n: int) -> np.ndarray:
    """Covariance of ``values`` of all rows; what rounding left of their mean is taken out."""
    schema = "part int, sums binary"
    parts = rows.mapInArrow(_products(values, width), schema).groupBy("part").applyInArrow(_added, schema)
    found = sorted(parts.collect(), key=lambda r: r["part"])  # at most PARTS rows
    total = sum((np.frombuffer(r["sums"]).reshape(width + 1, width) for r in found), np.zeros((width + 1, width)))
    rest = total[-1] / n
    return total[:-1] / n - np.outer(rest, rest)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the column ``vector`` of ``rows``; None without a usable vector."""
    ship(rows.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _column(batch, "vector")
            size = pa.compute.list_value_length(vectors.filter(pa.array(usable(vectors))))
            yield pa.RecordBatch.from_arrays([size.cast(pa.int64())], ["size"])

    common = rows.mapInArrow(lengths, "size long").groupBy("size").agg(F.count("*").alias("n"))
    first = common.orderBy(F.desc("n"), F.desc("size")).first()
    if first is None:
        return None
    size = first["size"]
    told = rows.mapInArrow(_sums(size), "place long, n long, up long, down long, low long, high long")
    per = told.groupBy("place").agg(
        F.sum("n").alias("n"), F.sum("up").alias("up"), F.sum("down").alias("down"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ).orderBy("place").collect()  # a row for each dimension
    n, sums = per[0]["n"], [(r["up"] << 31) + r["down"] for r in per]
    most = max(max(abs(n * r["low"] - s), abs(n * r["high"] - s)) for r, s in zip(per, sums))
    made = Whitening(size, n, sums, np.zeros(0), np.zeros((size, 0)), 0.0, most)
    v = _covariance(rows, lambda b: made.centred(integers(_column(b, "vector"), size)[0]), size, n)
    values, vectors = refined(v)
    made.trace = float(np.trace(v))
    use = values[:components] > made.trace * size * 1e-13
    made.values, made.vectors = values[:components][use], vectors[:, :components][:, use]
    return made


def transform(rows: DataFrame, made: Whitening, key: str) -> DataFrame:
    """``key``, ``whitened`` (array), ``deviation`` and ``deviation_text`` of each usable row."""
    sent = rows.sparkSession.sparkContext.broadcast(made)
    kind = rows.schema[key].dataType

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            x, at = integers(_column(batch, "vector"), own.size)
            white = own.project(x)
            exact = own.deviations(x)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(at)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel())),
                    pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()),
                    pa.array([str(v) for v in exact], pa.string()),
                ],
                [key, "whitened", "deviation", "deviation_text"],
            )

    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
            T.StructField("deviation", T.LongType()),
            T.StructField("deviation_text", T.StringType()),
        ]
    )
    return rows.select(key, "vector").mapInArrow(project, schema)


def whiten(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, deviation_text, whitened, explained and identity_error of
    every usable row and component."""
    rows = embeddings.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    made = fit(rows, components)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, deviation_text string, whitened double, explained double, identity_error double"
    if made is None or not len(made.values):
        return rows.sparkSession.createDataFrame([], schema)
    width = len(made.values)
    done = stored(transform(rows, made, "vec_id"), "whitened")
    error = _covariance(
        done.select("whitened"),
        lambda b: np.asarray(_column(b, "whitened").flatten()).reshape(-1, width),
        width,
        made.n,
    ) - np.eye(width)
    explained = F.array(*[F.lit(float(v / made.trace)) for v in made.values])
    return done.select(
        "vec_id", "deviation", "deviation_text", F.posexplode("whitened").alias("nth", "whitened")
    ).select(
        "vec_id",
        (F.col("nth") + 1).alias("component"),
        F.lit(made.n).cast("long").alias("n"),
        "deviation",
        "deviation_text",
        "whitened",
        F.get(explained, F.col("nth")).alias("explained"),
        F.lit(float(np.abs(error).max())).alias("identity_error"),
    )


def op11_refined_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
