"""Bring a caller's schema into the shape the operators take."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from turnloom.functions.templates import normal_role
from turnloom.schemas import CONVERSATIONS, check_columns, keyless, message

Adapter = Callable[[DataFrame], DataFrame]


def from_sharegpt(df: DataFrame, column: str = "conversations") -> DataFrame:
    """Message lists of ``from`` / ``value`` to ``messages`` of ``role`` / ``content``."""
    messages = F.transform(column, lambda m: message(normal_role(m["from"]), m["value"]))
    return df.withColumn("messages", messages).drop(column)


def from_role_content(df: DataFrame, column: str = "messages") -> DataFrame:
    """Message lists of ``role`` / ``content`` with roles normalised."""
    messages = F.transform(column, lambda m: message(normal_role(m["role"]), m["content"]))
    return df.withColumn("messages", messages)


def turns_from_sharegpt(df: DataFrame) -> DataFrame:
    """Long turns with ``from`` / ``value`` columns to ``role`` / ``content``: a projection."""
    return df.withColumns({"role": normal_role(F.col("from")), "content": F.col("value")}).drop(
        "from", "value"
    )


ADAPTERS: dict[str, Adapter] = {"sharegpt": from_sharegpt, "role_content": from_role_content}


def adapt(
    df: DataFrame, adapter: str | Adapter, result: T.StructType = CONVERSATIONS
) -> DataFrame:
    """Apply a built-in or the caller's own adapter and check what it returns; a key may be
    of any type."""
    fn = ADAPTERS[adapter] if isinstance(adapter, str) else adapter
    return check_columns(df.transform(fn), keyless(result))
