"""The corpus pipeline: five stages over ``documents``, each applying one operator of
``turnloom.llm`` to all that the stage before has kept.

1. toxicity: a network is trained on a bounded sample of ``labels`` and scores every
   document; those with a score of one half or more go.
2. n-gram Jaccard join: documents link at a similarity of 80 percent of their sets of five-word
   shingles (op9 takes 85 and four); of each component of linked documents the least doc_id stays.
3. benchmark decontamination: passages of ``benchmark`` are cut out; documents that consist
   of them for more than half go.
4. mixing: documents are taken (up to twice) in the proportions of the source weights.
5. sharding: the mix is dealt to 40 shards in uniformly random order.

Null texts score 0, link with nothing, have no hits and size 0, so the mix leaves them out. Rows
with a null doc_id pass the second stage; of repeated rows of a document one stays. Empty tables give
no rows; without labels of both kinds no document is toxic. SQL cannot express the stages (a trained
network, a drawn matrix), so there is no ``ORACLE_SQL``: ``tests/llm/test_chain.py`` runs the stages in
turn and compares each with brute force on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from turnloom.llm.common import stored, table

NEAR_WORDS = 5
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", deal_to_shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
