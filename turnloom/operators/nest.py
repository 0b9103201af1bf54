"""Long turns to one row per conversation, safe against very long conversations.

The nested shape puts a conversation into one cell, so one task has to hold it. That is
right for ordinary chats, and wrong when a single ``conv_id`` holds a large share of the
table. Conversations longer than ``max_turns`` are therefore found first (a count over
the key column alone) and kept as consecutive rows of ``max_turns`` messages; the column
``first_pos`` says where each row begins. ``max_turns`` is even, so the user/assistant
pair at positions (2k, 2k+1) never crosses a row boundary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from turnloom.operators.rank import BROADCAST_ROWS, range_rank
from turnloom.schemas import TURNS, check_columns
from turnloom.session import shared_dir

MAX_TURNS = 1024
SALTS = 32
KEY = "conv_id"
SIDES = ("chosen", "rejected")
# What turns must have besides the key, which may be of any type that can be ordered.
TURN_COLUMNS = T.StructType([f for f in TURNS.fields if f.name != KEY])


@dataclass(frozen=True)
class Nested:
    """Conversations as rows: ``whole`` ones, and long ones as ``parts`` (if any)."""

    whole: DataFrame
    parts: DataFrame | None = None
    skips_system: bool = False  # parts begin after a leading system message

    @property
    def rows(self) -> DataFrame:
        """All rows, for operators that look at one row at a time."""
        return self.whole if self.parts is None else self.whole.unionByName(self.parts)

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> Nested:
        parts = None if self.parts is None else fn(self.parts)
        return Nested(fn(self.whole), parts, self.skips_system)


def from_rows(df: DataFrame) -> Nested:
    """A table that is already nested: one row per conversation, no shuffle."""
    return Nested(df.withColumn("first_pos", F.lit(0).cast("bigint")))


def _long_keys(probe: DataFrame, max_turns: int) -> tuple[DataFrame, bool] | None:
    """Keys with more than ``max_turns`` rows (on one side), and whether they are few.

    One scan of the key columns, before the query runs. None if there are no such keys.
    """
    if max_turns < 2 or max_turns % 2:
        raise ValueError("max_turns must be even and at least 2")
    sizes = probe.groupBy(KEY, *(["side"] if "side" in probe.columns else [])).agg(
        F.count("*").alias("_n")
    )
    long = sizes.filter(F.col("_n") > max_turns).select(KEY).distinct()
    if long.isEmpty():
        return None
    shared_dir(probe.sparkSession)
    long = long.checkpoint()
    return long, long.count() <= BROADCAST_ROWS


def _attach(
    rows: DataFrame, per_key: DataFrame, on: Sequence[str], few: bool, spread: str, how: str = "inner"
) -> DataFrame:
    """Join rows with a table that has a row per long key.

    Few such rows, as counted, are broadcast. Otherwise each is repeated ``SALTS`` times and
    the rows of a key are spread by the hash of ``spread``, so that they never meet in one task.
    """
    if few:
        return rows.join(F.broadcast(per_key), list(on), how)
    salts = F.explode(F.array(*[F.lit(k) for k in range(SALTS)])).alias("_salt")
    salted = rows.withColumn("_salt", F.pmod(F.hash(spread), F.lit(SALTS)))
    return salted.join(per_key.select("*", salts), [*on, "_salt"], how).drop("_salt")


def _in_parts(
    rows: DataFrame, group: Sequence[str], max_turns: int, few: bool, skip_system: bool
) -> DataFrame:
    """Add ``first_pos`` to the turns of long conversations, whose positions are ranks
    in a range-partitioned order: no task sees a whole conversation.

    With ``skip_system``, a system message that leads all sides is a part of its own, so
    the exchanges after it do not lie across parts.
    """
    start_of_content = F.substring("content", 1, 32)
    ranked = range_rank(
        rows, [*group, "turn", "role", "content"], bounds=[*group, "turn", "role", start_of_content]
    )
    starts = ranked.groupBy(*group).agg(
        F.min("rank").alias("_start"), F.min_by("role", "rank").alias("_lead")
    )
    if skip_system:
        leads = starts.groupBy(KEY).agg(
            (F.count_if(F.col("_lead") == "system") == len(SIDES)).alias("_skip")
        )
        starts = starts.join(leads, KEY)
    else:
        starts = starts.withColumn("_skip", F.lit(False))
    pos = F.col("rank") - F.col("_start")
    placed = _attach(ranked, starts.drop("_lead"), group, few, "turn")
    shifted = F.when(pos > 0, (pos - 1) - (pos - 1) % max_turns + 1).otherwise(0)
    first = F.when(F.col("_skip"), shifted).otherwise(pos - pos % max_turns)
    return placed.withColumn("first_pos", first).drop("rank", "_start", "_skip")


def _in_turn_order(keep: Column | None = None) -> Column:
    """Message list of a group in turn order; ties are broken by role and content."""
    turn = F.struct("turn", "role", "content")
    ordered = F.sort_array(F.collect_list(turn if keep is None else F.when(keep, turn)))
    return F.transform(
        ordered, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))
    )


def _gather(
    turns: DataFrame,
    group: Sequence[str],
    aggs: Sequence[Column],
    max_turns: int | None,
    probe: DataFrame | None,
    null_key: str,
    totals: Sequence[Column] = (),
    skip_system: bool = False,
) -> Nested:
    """Aggregate per conversation, or per part of a long one; ``totals`` are taken over
    the whole of a long conversation and added to each of its parts."""
    check_columns(turns, TURN_COLUMNS)
    if null_key not in ("drop", "refuse"):
        raise ValueError(f"unknown rule for null keys {null_key!r}")
    if null_key == "drop":
        turns = turns.filter(F.col(KEY).isNotNull())
    else:
        refused = F.raise_error(F.lit(f"a turn has no {KEY}")).cast(turns.schema[KEY].dataType)
        turns = turns.withColumn(KEY, F.coalesce(F.col(KEY), refused))
    found = None
    if max_turns is not None:
        seen = turns if probe is None else probe.filter(F.col(KEY).isNotNull())
        found = _long_keys(seen, max_turns)
    if found is None:
        whole = turns.groupBy(KEY).agg(F.lit(0).cast("bigint").alias("first_pos"), *aggs)
        return Nested(whole, None, skip_system)
    long, few = found
    short = _attach(turns, long, [KEY], few, "turn", "left_anti")
    whole = short.groupBy(KEY).agg(F.lit(0).cast("bigint").alias("first_pos"), *aggs)
    chosen = _attach(turns, long, [KEY], few, "turn", "left_semi")
    placed = _in_parts(chosen, group, max_turns, few, skip_system)
    parts = placed.groupBy(KEY, "first_pos").agg(*aggs)
    if totals:
        parts = _attach(parts, placed.groupBy(KEY).agg(*totals), [KEY], few, "first_pos")
    return Nested(whole, parts, skip_system)


def nest_turns(
    turns: DataFrame,
    max_turns: int | None = MAX_TURNS,
    probe: DataFrame | None = None,
    null_key: str = "drop",
) -> Nested:
    """``turns`` to ``(conv_id, first_pos, messages)`` with one shuffle.

    ``probe`` may name a cheaper table with at least as many rows per ``conv_id`` (and
    side, if it has sides), used to look for long conversations when ``turns`` itself is
    costly to compute. Looking for them takes a job of its own; ``max_turns=None`` leaves it
    out where all conversations are known to fit into a cell. Rows without a key belong to no
    conversation: they are dropped, or with ``null_key="refuse"`` the job fails.
    """
    messages = _in_turn_order().alias("messages")
    return _gather(turns, [KEY], [messages], max_turns, probe, null_key)


def nest_preferences(
    turns: DataFrame,
    keep: Sequence[str] = ("source",),
    max_turns: int | None = MAX_TURNS,
    probe: DataFrame | None = None,
    null_key: str = "drop",
    skip_leading_system: bool = False,
) -> Nested:
    """Turns with a ``side`` (chosen / rejected) to preference rows, with one shuffle.

    Both message lists are gathered in the same aggregation. Columns in ``keep`` are
    constant per conversation. ``n_chosen`` and ``n_rejected`` count the turns of the
    whole conversation, also where the row is a part of it. ``max_turns`` counts the turns of
    one side. ``skip_leading_system`` cuts long conversations for pairs that begin after a
    system message.
    """
    aggs = [F.max(c).alias(c) for c in keep]
    aggs += [_in_turn_order(F.col("side") == s).alias(s) for s in SIDES]
    totals = [F.count_if(F.col("side") == s).alias(f"n_{s}") for s in SIDES]
    nested = _gather(
        turns, [KEY, "side"], aggs, max_turns, probe, null_key, totals, skip_leading_system
    )
    return Nested(_sized(nested.whole), nested.parts, skip_leading_system)


def preference_rows(df: DataFrame) -> Nested:
    """Preference rows that are already nested, in the same shape as above."""
    return from_rows(df).map(_sized)


def _sized(df: DataFrame) -> DataFrame:
    sizes = {s: F.coalesce(F.size(s), F.lit(0)).cast("bigint") for s in SIDES}
    return df.withColumns({f"n_{s}": size for s, size in sizes.items()})
