"""Small helpers the operators share."""

from __future__ import annotations

import math
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import turnloom
from turnloom.session import fresh_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(
    df: DataFrame, label: str, group_bytes: int | None = None, compression: str | None = None
) -> DataFrame:
    """``df`` written once to the shared folder and read from there by every later pass.

    ``group_bytes`` bounds the row groups, and so what a reader holds of rows that are large.
    """
    path = fresh_path(df.sparkSession, label)
    write = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` written once to the shared folder in buckets of ``key``: later joins on it move
    only the other side."""
    path = fresh_path(df.sparkSession, "bucketed")
    name = "turnloom_" + path.rsplit("-", 1)[1]
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def word_count(text: Column) -> Column:
    """Number of words of a whole text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key without nulls: "=" and the source; "" for a null source."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def hex_digits(rows: int, per_bucket: int, most: int = 6) -> int:
    """Leading hex digits of a hash that make buckets of about ``per_bucket`` rows."""
    return max(1, min(most, math.ceil(math.log(max(rows, 1) / per_bucket, 16))))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    The driver serves the file; executors need no installation of their own.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(turnloom.__file__).parent
    path = f"{tempfile.mkdtemp(prefix='turnloom-package-')}/turnloom.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as made:
        for module in sorted(package.rglob("*.py")):
            made.write(module, module.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
