"""Mix sources to target weights by weighted fair queueing (DataFrame operations only).

Every document stands in the queue of its source, in the order of a seeded md5, and may be
served ``repeats`` times. The virtual finish time of a copy is the number of words that its
source has served up to and with this copy, divided by the source's target. Serving all
copies in the order of virtual time gives every source its share at every moment; the mix
ends where the total budget is used up.

Nothing is gathered by source: words before a row are the words of the hash buckets before
its own (a table of sums), plus a running sum within ``(source, bucket)``. Buckets are made
from leading hash digits, more of them for more rows, so a source with a third of all rows
is spread as evenly as the others. The end of the mix is found in a histogram of virtual
time and in the one bucket where the budget ends.

Defined results: a null text has size 0 and takes nothing; a null source is a source of its
own, the last one; repeated rows are documents of their own; an empty table gives no rows;
further columns of the input are kept by ``mix`` (names that begin with ``_mix`` are used
here and must not occur).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from turnloom.llm.common import hex_digits, source_key, stored, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
ROWS_PER_BUCKET = 256
TIME_BUCKETS = 4096


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """``sizes`` (key, source_size), one row per source, with each source's ``target``.

    Targets are proportional to the weights, dealt in code-point order of the sources, and
    stop at ``repeats`` times the size; what is cut off is shared again by weight. In the
    order of size by weight the common level is the largest of the levels that follow if
    all sources before are cut off, so no iteration is needed. The windows run over one row
    per source.
    """
    order = F.when(F.col("_mix_key") == "", 1).otherwise(0)
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(order, "_mix_key")) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    most = F.col("source_size") * float(repeats)
    whole = W.partitionBy(F.lit(0))
    by_ratio = whole.orderBy(F.col("_mix_most") / F.col("_mix_w"), "_mix_key")
    budget = F.sum("source_size").over(whole) * share
    before = F.sum("_mix_most").over(by_ratio) - F.col("_mix_most")
    left = F.sum("_mix_w").over(whole) - F.sum("_mix_w").over(by_ratio) + F.col("_mix_w")
    return (
        sizes.withColumn("_mix_w", weight)
        .withColumn("_mix_most", most)
        .withColumn("_mix_level", (budget - before) / left)
        .withColumn("_mix_level", F.max("_mix_level").over(whole))
        .withColumn("target", F.least("_mix_most", F.col("_mix_level") * F.col("_mix_w")))
        .select("_mix_key", "source_size", "target")
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = 0,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, first_finish.

    ``first_finish`` is the virtual finish time of the first copy; ``_mix_key``,
    ``_mix_hash`` and ``copies`` are for ``mix``.
    """
    rows = stored(
        docs.select(
            "doc_id",
            source_key(F.col("source")).alias("_mix_key"),
            word_count(F.col("text")).alias("size"),
            F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))).alias(
                "_mix_hash"
            ),
        ),
        "mix",
    )
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = total * share
    bucket = F.substring("_mix_hash", 1, hex_digits(n, ROWS_PER_BUCKET))
    rows = rows.withColumn("_mix_bucket", bucket)
    per_bucket = rows.groupBy("_mix_key", "_mix_bucket").agg(F.sum("size").alias("_mix_sum"))
    sums = W.partitionBy("_mix_key").orderBy("_mix_bucket")
    before = per_bucket.withColumn("_mix_before", F.sum("_mix_sum").over(sums) - F.col("_mix_sum"))
    sizes = per_bucket.groupBy("_mix_key").agg(F.sum("_mix_sum").alias("source_size"))
    offsets = before.join(source_targets(sizes, weights, share, repeats), "_mix_key").drop(
        "_mix_sum"
    )
    running = (
        W.partitionBy("_mix_key", "_mix_bucket")
        .orderBy("_mix_hash", "doc_id", "size")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    served = (
        rows.withColumn("_mix_in", F.sum("size").over(running))
        .join(offsets, ["_mix_key", "_mix_bucket"])
        .withColumn("_mix_cum", F.col("_mix_before") + F.col("_mix_in"))
        .drop("_mix_before", "_mix_in", "_mix_bucket")
    )
    served = stored(served, "mix-served")
    copies = served.filter("size > 0").select(
        "size",
        F.explode(
            F.array(*[_entry(copy).alias(f"c{copy}") for copy in range(repeats)])
        ).alias("_mix_entry"),
    )
    cut = _cut(copies, budget)
    if cut is None:
        count = F.lit(0)
    else:
        last = F.struct(*[F.lit(v).alias(k) for k, v in cut.asDict().items()])
        count = sum(
            (F.when(_entry(copy) <= last, 1).otherwise(0) for copy in range(repeats)), F.lit(0)
        )
    count = F.when(F.col("size") > 0, count).otherwise(0)
    return served.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (count * F.col("size")).cast("long").alias("taken"),
        _entry(0)["finish"].alias("first_finish"),
        count.alias("copies"),
        "_mix_key",
        "_mix_hash",
        "_mix_cum",
    )


def _entry(copy: int):
    """The place of a copy in the global order of virtual time."""
    words = F.col("source_size") * copy + F.col("_mix_cum")
    return F.struct(
        F.when(F.col("target") > 0, words / F.col("target")).alias("finish"),
        F.col("_mix_key").alias("key"),
        words.alias("words"),
    )


def _cut(copies: DataFrame, budget: float):
    """The last entry within the budget, or None if not even the first fits.

    A histogram over ranges of virtual time shows the range where the budget ends; only
    the entries of this range are sorted. Sources are served at even speed, so ranges hold
    about equally many words; what finishes after four times the planned end is one range.
    """
    time = F.least(F.floor(F.col("_mix_entry.finish") * TIME_BUCKETS), F.lit(4 * TIME_BUCKETS))
    copies = copies.withColumn("_mix_time", time)
    sums = copies.groupBy("_mix_time").agg(F.sum("size").alias("_mix_sum"))
    upto = F.sum("_mix_sum").over(W.partitionBy(F.lit(0)).orderBy("_mix_time"))
    ends = sums.withColumn("_mix_before", upto - F.col("_mix_sum")).filter(
        F.col("_mix_before") < budget
    )
    edge = ends.orderBy(F.desc("_mix_time")).first()
    if edge is None:
        return None
    order = W.partitionBy("_mix_time").orderBy("_mix_entry").rowsBetween(W.unboundedPreceding, 0)
    fits = (
        copies.filter(F.col("_mix_time") == edge["_mix_time"])
        .withColumn("_mix_upto", F.sum("size").over(order) + edge["_mix_before"])
        .filter(F.col("_mix_upto") <= budget)
    )
    last = fits.agg(F.max("_mix_entry").alias("last")).first()["last"]
    if last is None:
        earlier = copies.filter(F.col("_mix_time") < edge["_mix_time"])
        last = earlier.agg(F.max("_mix_entry").alias("last")).first()["last"]
    return last


def mix(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as often as taken, in global order of
    virtual time (range-partitioned and sorted), with their columns unchanged.

    Rows are matched by doc_id, source, size and, for repeated doc_ids, by their number
    among equal ones.
    """
    same = W.partitionBy("_mix_id", "_mix_key", "_mix_size")
    keyed = docs.select(
        "*",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_mix_id"),
        source_key(F.col("source")).alias("_mix_key"),
        word_count(F.col("text")).alias("_mix_size"),
    ).withColumn("_mix_nth", F.row_number().over(same.orderBy("text")))
    plan = (
        mix_plan(docs, seed=seed, **options)
        .withColumn("_mix_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        .withColumnRenamed("size", "_mix_size")
        .withColumn("_mix_nth", F.row_number().over(same.orderBy("_mix_cum")))
        .filter("copies > 0")
    )
    entries = plan.select(
        "_mix_id",
        "_mix_key",
        "_mix_size",
        "_mix_nth",
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("_mix_copy"),
        "source_size",
        "target",
        "_mix_cum",
    ).withColumn(
        "_mix_finish",
        (F.col("source_size") * F.col("_mix_copy") + F.col("_mix_cum")) / F.col("target"),
    )
    entries = entries.drop("source_size", "target", "_mix_cum")
    joined = keyed.join(entries, ["_mix_id", "_mix_key", "_mix_size", "_mix_nth"])
    order = ["_mix_finish", "_mix_key", "_mix_id", "_mix_copy"]
    return (
        joined.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op5_fair_queueing(spark, sf_dir):
    from turnloom.llm.common import table

    return mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0' || coalesce(':' || doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT coalesce('=' || source, '') AS k, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0]::DOUBLE[] AS ws FROM d GROUP BY 1),
o AS (
  SELECT k, source_size, source_size * 2.0::DOUBLE AS most,
         ws[1 + ((row_number() OVER (ORDER BY k = '', k) - 1) % 3)::INT] AS w FROM s),
l AS (
  SELECT k, source_size, most, w,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
            - (sum(most) OVER (ORDER BY most / w, k) - most))
         / (sum(w) OVER () - sum(w) OVER (ORDER BY most / w, k) + w) AS level
  FROM o),
t AS (
  SELECT k, source_size, least(most, (max(level) OVER ()) * w) AS target FROM l),
c AS (
  SELECT doc_id, size, source_size, target, k,
         (sum(size) OVER (PARTITION BY t.k ORDER BY h, doc_id, size
                          ROWS UNBOUNDED PRECEDING))::BIGINT AS cum
  FROM d JOIN t ON t.k = coalesce('=' || source, '')),
e AS (
  SELECT doc_id, k, size, (source_size * n + cum)::BIGINT AS words,
         (source_size * n + cum)::DOUBLE / target AS finish
  FROM c, (VALUES (0), (1)) r(n) WHERE size > 0),
m AS (
  SELECT *, sum(size) OVER (ORDER BY finish, k, words ROWS UNBOUNDED PRECEDING) AS upto FROM e),
g AS (
  SELECT doc_id, sum(size)::BIGINT AS taken FROM m
  WHERE upto <= (SELECT sum(size) * 1.5 FROM d) GROUP BY 1)
SELECT c.doc_id, c.size, c.source_size, c.target, coalesce(g.taken, 0)::BIGINT AS taken
FROM c LEFT JOIN g ON g.doc_id = c.doc_id
"""
