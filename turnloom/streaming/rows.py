"""File streams of nested rows through row-local operators.

Templates, adapters, source filters and pair extraction look at one nested row at a
time, so they take a streaming DataFrame as it is: no state and no watermark. Operators
that rank, split or nest need the whole table and stay batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery


def read_rows(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json"
) -> DataFrame:
    """Stream of files that arrive below ``path``."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def run_rows(
    rows: DataFrame,
    operator: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Process what has arrived, then stop; a later call continues from ``checkpoint``."""
    return (
        operator(rows)
        .writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
