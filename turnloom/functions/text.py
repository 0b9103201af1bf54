"""String helpers whose results must equal Python's string methods."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The 29 code points Python's str.strip() removes. Spark's trim() removes
# only U+0020 and the regex class \s only six of them, so the set is passed to btrim().
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """``str.strip()`` with no argument."""
    return F.btrim(text, F.lit(WHITESPACE))


def after_last(text: Column, mark: str) -> Column:
    """Text after the last ``mark``; the whole text if it is absent."""
    return F.substring_index(text, mark, -1)


def before_first(text: Column, mark: str) -> Column:
    """Text before the first ``mark``; the whole text if it is absent."""
    return F.substring_index(text, mark, 1)


def count_tokens(text: Column) -> Column:
    """Number of runs of non-space characters: a proxy for a model's token count."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("bigint")


def first_tokens(text: Column, n: int) -> Column:
    """The text up to the end of its ``n``-th token.

    Possessive quantifiers keep the match iterative: no backtracking, no deep stack.
    """
    return F.regexp_extract(text, rf"^(?:\s*+\S++){{0,{n}}}+", 0)
