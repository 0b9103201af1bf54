"""True token counts and cuts at a token, by a byte-level vocabulary of merges.

The vocabulary is a file of ranks: a line holds a token in base64 and its rank. Spark reads it,
so it may lie wherever inputs lie. It is sent to the tasks behind a check of its size
(``MAX_TOKENS``); a task builds its encoder once. Only the text column goes through Python, as
Arrow arrays, and counting is a column expression: no row is shuffled, and no other column
leaves the JVM.

Defined results: a null text has a null count and a null cut; an empty one has no tokens. Special
tokens are ordinary text here. A budget cut keeps the whole characters that lie within the first
``budget`` tokens of the text; a character whose last bytes lie beyond is left out. Very long texts and
words are encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_TOKENS = 1_000_000
# How byte-level vocabularies of this kind cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

FOUND = "struct<n_tokens:bigint,n_bytes:bigint,n_chars:int>"


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file; at most ``MAX_TOKENS``, each of them once."""
    parts = F.split("value", " ")
    lines = spark.read.text(path).filter("value != ''")
    rows = lines.select(F.unbase64(parts[0]).alias("token"), parts[1].cast("int").alias("rank"))
    found = rows.limit(MAX_TOKENS + 1).collect()
    ranks = {bytes(r["token"]): r["rank"] for r in found}
    if len(found) > MAX_TOKENS:
        raise ValueError(f"{path} holds more than {MAX_TOKENS} tokens")
    if len(set(ranks.values())) != len(found) or None in ranks.values():
        raise ValueError(f"{path} is no list of tokens with a rank each")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} lacks single bytes, so it cannot encode every text")
    return ranks


class Tokens:
    """Column expressions over one vocabulary."""

    def __init__(self, spark: SparkSession, path: str, words: str = WORDS) -> None:
        self._sent = spark.sparkContext.broadcast(read_ranks(spark, path))
        self._words = words

    def measured(self, text: Column, budget: int | None = None) -> Column:
        """``n_tokens``, ``n_bytes`` of those tokens, and the ``n_chars`` that lie within the first
        ``budget`` of them (all, without one)."""
        sent, words = self._sent, self._words

        def measure(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import tiktoken

            coder = tiktoken.Encoding("own", pat_str=words, mergeable_ranks=sent.value, special_tokens={})
            for part in parts:
                yield pa.array([_measured(coder, cell.as_py(), budget) for cell in part], _ARROW)

        return F.arrow_udf(measure, FOUND)(text)

    def count(self, text: Column) -> Column:
        """Number of tokens."""
        return self.measured(text)["n_tokens"]


_ARROW = pa.struct([("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("n_chars", pa.int32())])


def _measured(coder, text: str | None, budget: int | None) -> dict | None:
    if text is None:
        return None
    ids = coder.encode_ordinary(text)
    n_bytes = len(coder.decode_bytes(ids))
    if budget is None or len(ids) <= budget:
        n_chars = len(text)
    else:
        n_chars = len(coder.decode_bytes(ids[:budget]).decode("utf-8", errors="ignore"))
    return {"n_tokens": len(ids), "n_bytes": n_bytes, "n_chars": n_chars}


def token_budget(df: DataFrame, tokens: Tokens, budget: int = 1024, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``over_budget`` and ``cut_text``, the text within its first ``budget``
    true tokens. Columns of these names are replaced.

    ``shaping.length_budget`` with ``token_count_col`` cuts at a word instead.
    """
    if budget < 0:
        raise ValueError("budget must not be negative")
    found, cell = "_measured", F.col(text)
    while found in df.columns:
        found += "_"
    measured = df.withColumn(found, tokens.measured(cell, budget))
    n_tokens, n_chars = F.col(found)["n_tokens"], F.col(found)["n_chars"]
    return measured.withColumns(
        {
            "n_tokens": n_tokens,
            "over_budget": n_tokens > budget,
            "cut_text": F.when(n_tokens > budget, F.substring(cell, F.lit(1), n_chars)).otherwise(cell),
        }
    ).drop(found)
