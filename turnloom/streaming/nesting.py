"""Conversations from a stream of turns.

Turns arrive as files in any order. A conversation is a session: turns of one ``conv_id`` whose
times are at most ``gap`` apart. State is one session window per open conversation; the watermark
(the latest time seen less ``delay``) closes it, and only then it is written, once. Turns that
come after their session was closed are not added to it: ``late_turns`` gives them apart, from the
stored turns and the stored sessions. Restarting from the checkpoint goes on where the last run
ended; the file sink commits a batch's files together, so no session is written twice.

A session stays open until later turns move the watermark past it: at the end of a stream, the last
``delay + gap`` of time is still in the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from turnloom.operators.nest import _in_turn_order
from turnloom.streaming.rows import read_rows, run_rows

TURNS_IN_TIME = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)


def nest_stream(turns: DataFrame, delay: str, gap: str) -> DataFrame:
    """``conv_id, session_start, session_end, first_pos, messages`` of closed sessions.

    ``turns`` has the columns of ``TURNS_IN_TIME``, streaming or not. Turns without a key or a
    time belong to no session and are dropped.
    """
    known = turns.filter(F.col("conv_id").isNotNull() & F.col("at").isNotNull())
    window = F.session_window("at", gap).alias("_session")
    sessions = known.withWatermark("at", delay).groupBy(window, "conv_id").agg(
        _in_turn_order().alias("messages")
    )
    return sessions.select(
        "conv_id",
        F.col("_session.start").alias("session_start"),
        F.col("_session.end").alias("session_end"),
        F.lit(0).cast("bigint").alias("first_pos"),
        "messages",
    )


def run_nesting(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    delay: str,
    gap: str,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Nest the turn files that have arrived below ``path``, then stop; a later call goes on."""
    turns = read_rows(spark, path, TURNS_IN_TIME, fmt)
    return run_rows(turns, lambda df: nest_stream(df, delay, gap), out, checkpoint)


def late_turns(turns: DataFrame, sessions: DataFrame, closed_to: str) -> DataFrame:
    """The stored ``turns`` before the time ``closed_to`` that no stored session holds.

    ``closed_to`` is a watermark that the stream has passed by more than the session gap. A turn
    is held if a session of its conversation covers its time and has a message like it; equal
    turns of a session are held together. Sessions are matched by conversation, and their
    messages unfolded beside their key, so no list is compared with another.
    """
    seen = sessions.select(
        "conv_id", "session_start", "session_end", F.inline("messages")
    ).distinct()
    t, s = turns.filter(F.col("at") < F.lit(closed_to).cast("timestamp")).alias("t"), seen.alias("s")
    same = (
        (F.col("t.conv_id") == F.col("s.conv_id"))
        & F.col("t.role").eqNullSafe(F.col("s.role"))
        & F.col("t.content").eqNullSafe(F.col("s.content"))
        & (F.col("t.at") >= F.col("s.session_start"))
        & (F.col("t.at") < F.col("s.session_end"))
    )
    return t.join(s, same, "left_anti")
