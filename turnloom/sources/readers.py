"""Read conversation, preference and pair tables with declared schemas.

JSON schemas are never inferred: inference costs a pass over the data and orders struct
fields by name. A JSON line that is broken, or does not fit the schema, fails the job that
reads it; with ``on_bad="keep"`` it comes as a row of nulls with the line in
``_corrupt_record``.

The key of a conversation may be of any type that can be ordered. Tables without one get
it from ``with_key`` (files) or ``with_stored_key`` (anything).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from turnloom.operators.nest import KEY, TURN_COLUMNS
from turnloom.schemas import CHAT_PAIRS, CONVERSATIONS, PREFERENCES, SchemaError, check_columns, keyless
from turnloom.session import fresh_path

FORMATS = ("parquet", "json")
CORRUPT = "_corrupt_record"


def _read(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str, on_bad: str = "fail"
) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; have {FORMATS}")
    if on_bad not in ("fail", "keep"):
        raise ValueError(f"unknown rule for bad lines {on_bad!r}")
    if fmt == "parquet":
        df = spark.read.parquet(path)
        if KEY in df.columns:
            return check_columns(df, keyless(schema))
        return check_columns(with_key(df), keyless(schema))
    reader = spark.read
    if on_bad == "fail":
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    lines = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(lines).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def with_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Add a key to rows read directly from Parquet files: file name and row position.

    Both belong to the file, so the key is the same in every run and under any partitioning,
    and nothing is ranked. File names must be unique below the path that was read.
    """
    name = F.substring_index("_metadata.file_path", "/", -1)
    place = F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0")
    return df.select(F.concat_ws(":", name, place).alias(key), "*")


def with_stored_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Add a key to rows of any origin: they are written once to the shared folder, in their
    present partitions, and keyed by partition and position."""
    path = fresh_path(df.sparkSession, "keyed")
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    place = F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0")
    # One partition may write several files, told apart by their number.
    more = F.regexp_extract("_metadata.file_name", r"-c(\d+)", 1)
    return kept.select(F.concat_ws(":", part, more, place).alias(key), "*")


def read_turns(spark: SparkSession, path: str, content: str = "text") -> DataFrame:
    """Long Parquet turns; ``content`` names the column with the message text."""
    turns = spark.read.parquet(path).withColumnRenamed(content, "content")
    if KEY not in turns.columns:
        raise SchemaError(f"missing column {KEY!r}; have {sorted(turns.columns)}")
    return check_columns(turns, TURN_COLUMNS).select(KEY, *TURN_COLUMNS.fieldNames())


def read_conversations(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = CONVERSATIONS,
    on_bad: str = "fail",
) -> DataFrame:
    """Nested conversations; pass ``schemas.SHAREGPT`` for from/value messages.

    Parquet rows without ``conv_id`` are keyed by ``with_key``.
    """
    return _read(spark, path, schema, fmt, on_bad)


def read_preferences(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = PREFERENCES,
    on_bad: str = "fail",
) -> DataFrame:
    """Nested preference rows with ``chosen`` and ``rejected`` message lists.

    Parquet rows without ``conv_id`` are keyed by ``with_key``.
    """
    return _read(spark, path, schema, fmt, on_bad)


def read_pairs(
    spark: SparkSession, path: str, schema: T.StructType = CHAT_PAIRS, on_bad: str = "fail"
) -> DataFrame:
    """JSONL pairs in chat format, as ``writers.write_jsonl`` leaves them.

    Pass ``schemas.keyed(CHAT_PAIRS, type)`` for keys that are not integers, and
    ``schemas.keyless(CHAT_PAIRS)`` for lines without keys.
    """
    return _read(spark, path, schema, "json", on_bad)


def read_dataset(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    """A saved dataset directory; ``split`` reads only that part's files."""
    df = spark.read.parquet(root)
    return df if split is None else df.filter(F.col("split") == split).drop("split")
