"""Quality by importance resampling: hashed n-gram models of target and raw text.

Features are hashed n-grams of one and two words, and of runs of punctuation, in ``BUCKETS``
buckets. The raw model counts the features of all documents, the target model those of
all documents labelled good. The importance
weight of a document is the ratio of its probabilities under the two models; it is taken for
a text of ``STANDARD`` features, so that length alone does not decide. Documents are drawn
without replacement by the Gumbel top-k method: seeded Gumbel noise is added to the log
weight, and the k highest keys are taken.

Counts are summed in each task, then in ``SUM_GROUPS`` groups; the driver adds up that many
vectors. The k-th key is found in histograms over narrowing ranges of narrow rows, so nothing
is sorted as a whole.

Defined results: a text without features has log weight 0; without target documents all
weights are 0; a null doc_id draws as an empty one; rows of one doc_id draw alike, ties at
the k-th key are broken by doc_id and weight; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from turnloom.llm.common import ship, stored, table
from turnloom.llm.toxicity import SEPARATOR
from turnloom.llm.words import SPACE, hash_words, slices

BUCKETS = 10_000
BROADCAST_IDS = 100_000
STANDARD = 200
FRACTION = 0.5
SUM_GROUPS = 32
BITS = 16

NOT_PUNCTUATION = ~SEPARATOR | SPACE


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every feature."""
    rows, buckets = [], []
    for kind, space in enumerate((SEPARATOR, NOT_PUNCTUATION)):
        words = hash_words(texts, space=space)
        for size in (1, 2):
            hashes, row, _ = words.windows(size)
            rows.append(row)
            buckets.append(((hashes >> np.uint64(7 + kind)) % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(buckets)


def count_features(docs: DataFrame) -> np.ndarray:
    """Counts of all features of ``docs`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                total += np.bincount(features(part.column("text"))[1], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    def add(rows: pa.Table) -> pa.Table:
        cells = rows.column("counts").to_pylist()
        total = sum((np.frombuffer(c, np.int64) for c in cells), np.zeros(BUCKETS, np.int64))
        return pa.table({"counts": pa.array([total.tobytes()], pa.binary())})

    vectors = docs.select("text").mapInArrow(count, "counts binary")
    grouped = vectors.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SUM_GROUPS)))
    sums = grouped.groupBy("part").applyInArrow(add, "counts binary").collect()
    return sum((np.frombuffer(r[0], np.int64) for r in sums), np.zeros(BUCKETS, np.int64))


def log_ratios(docs: DataFrame, labels: DataFrame, label: str) -> np.ndarray:
    """Log of target over raw probability of each bucket, with one added to every count."""
    good = labels.filter(F.col(label) == 1).select("doc_id").distinct()
    # Broadcast only after counting; beyond that the texts are joined by doc_id.
    few = good.count() <= BROADCAST_IDS
    target = count_features(docs.join(F.broadcast(good) if few else good, "doc_id", "left_semi"))
    if not target.sum():
        return np.zeros(BUCKETS)
    raw = count_features(docs)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def weigh(docs: DataFrame, ratios: np.ndarray, seed: int = 0) -> DataFrame:
    """(doc_id, n_features, log_weight, key) of each document."""
    ship(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows, buckets = features(part.column("text"))
                n = np.bincount(rows, minlength=part.num_rows)
                total = np.bincount(rows, ratios[buckets], part.num_rows)
                weight = total / np.maximum(n, 1) * STANDARD
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(weight)],
                    ["doc_id", "n_features", "log_weight"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", "text").mapInArrow(
        score, f"doc_id {kind}, n_features long, log_weight double"
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    uniform = (F.shiftrightunsigned(F.xxhash64(name, F.lit(seed)), 11) + F.lit(0.5)) / float(1 << 53)
    return weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def top_k(keyed: DataFrame, k: int) -> DataFrame:
    """``keyed`` (stored, with ``key``) with ``selected``: exactly the k highest keys."""
    place = F.col("key")
    low, high = keyed.agg(F.min(place), F.max(place)).first()
    if low is None or k <= 0:
        return keyed.withColumn("selected", F.lit(False))
    need = k
    # Narrow the range of the k-th key until it holds few rows or one value.
    while True:
        inside = keyed.filter((place >= low) & (place <= high))
        width = (high - low) / (1 << BITS)
        n = inside.count()
        if n <= 1 << BITS or low + width <= low:
            break
        bin_of = F.least(F.floor((place - F.lit(low)) / F.lit(width)), F.lit((1 << BITS) - 1))
        bins = sorted(
            inside.groupBy(bin_of.alias("bin")).agg(
                F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high")
            ).collect(),
            key=lambda r: -r["bin"],
        )
        for b in bins:
            if need <= b["n"]:
                low, high = b["low"], b["high"]
                break
            need -= b["n"]
        else:
            return keyed.withColumn("selected", F.lit(True))
        if low == high:
            break
    edge = keyed.filter((place >= low) & (place <= high))
    cuts = edge.groupBy("key").agg(F.count("*").alias("n")).orderBy(F.desc("key")).limit(1 << BITS)
    at = high
    for r in cuts.collect():
        at = r["key"]
        if need <= r["n"]:
            break
        need -= r["n"]
    ties = W.partitionBy("key").orderBy("doc_id", "log_weight")
    chosen = keyed.filter(place != at).withColumn("selected", place > at)
    tied = keyed.filter(place == at).withColumn("selected", F.row_number().over(ties) <= need)
    return chosen.unionByName(tied)


def resample(
    docs: DataFrame, labels: DataFrame, fraction: float = FRACTION, label: str = "quality", seed: int = 0
) -> DataFrame:
    """(doc_id, n_features, log_weight, key, selected); ``fraction`` of the rows is drawn."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    keyed = stored(weigh(docs, log_ratios(docs, labels, label), seed), "weights")
    return top_k(keyed, int(keyed.count() * fraction))


def op10_importance(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
