"""Declared schemas and the checks that go with them.

Two shapes of conversation data are used:

* turns (long): ``conv_id, turn, role, content``; preferences add ``side``.
* conversations (nested): one row per conversation with ``messages``;
  preferences carry ``chosen`` and ``rejected`` message lists.

Nested tables also carry ``first_pos``, the position of the first message of the row.
It is 0 unless a very long conversation was split (see ``operators.nest``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.ArrayType(MESSAGE)
SHAREGPT_MESSAGES = T.ArrayType(
    T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())])
)

TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)
CONVERSATIONS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("messages", MESSAGES)]
)
SHAREGPT = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("conversations", SHAREGPT_MESSAGES)]
)
PREFERENCES = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("chosen", MESSAGES),
        T.StructField("rejected", MESSAGES),
    ]
)
CHAT_PAIRS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("pair_idx", T.LongType()),
        T.StructField("prompt", MESSAGES),
        T.StructField("chosen", MESSAGES),
        T.StructField("rejected", MESSAGES),
    ]
)


def keyed(schema: T.StructType, key: T.DataType) -> T.StructType:
    """``schema`` with a ``conv_id`` of another type."""
    return T.StructType(
        [T.StructField(f.name, key if f.name == "conv_id" else f.dataType) for f in schema.fields]
    )


def keyless(schema: T.StructType) -> T.StructType:
    """``schema`` without the key columns, as data has it that was never keyed."""
    return T.StructType([f for f in schema.fields if f.name not in ("conv_id", "pair_idx")])


class SchemaError(ValueError):
    """A table lacks a column an operator needs, or has it with another type."""


def check_columns(df: DataFrame, required: T.StructType) -> DataFrame:
    """Fail at plan time, not mid-job, when ``df`` lacks a required column or type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for field in required.fields:
        if field.name not in have:
            raise SchemaError(f"missing column {field.name!r}; have {sorted(have)}")
        if _nullable(have[field.name]) != _nullable(field.dataType):
            raise SchemaError(
                f"column {field.name!r} is {have[field.name].simpleString()}, "
                f"need {field.dataType.simpleString()}"
            )
    return df


def _nullable(data_type: T.DataType) -> T.DataType:
    """The same type with every level nullable, so that checks ignore nullability."""
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_nullable(data_type.elementType), True)
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _nullable(f.dataType), True) for f in data_type.fields]
        )
    return data_type


def message(role: Column | str, content: Column | str) -> Column:
    """One ``struct<role, content>``; plain strings name columns."""
    return F.struct(
        (F.col(role) if isinstance(role, str) else role).alias("role"),
        (F.col(content) if isinstance(content, str) else content).alias("content"),
    )
