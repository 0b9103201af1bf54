"""Streamed nesting: equal to batch nesting, late turns apart, restarts."""

import datetime as dt

from turnloom.operators.nest import nest_turns
from turnloom.streaming.nesting import TURNS_IN_TIME, late_turns, nest_stream, run_nesting

DAY = dt.datetime(2024, 1, 1)


def turn(conv, nth, minute, text=None):
    at = None if minute is None else DAY + dt.timedelta(minutes=minute)
    return (conv, nth, "user" if nth % 2 == 0 else "assistant", text or f"{conv}:{nth}", at)


def write(spark, path, rows):
    spark.createDataFrame(rows, TURNS_IN_TIME).coalesce(1).write.mode("append").parquet(path)


def sessions(spark, out):
    rows = spark.read.parquet(out).collect()
    return sorted((r["conv_id"], [m["content"] for m in r["messages"]]) for r in rows)


def run(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("in", "out", "checkpoint")]
    run_nesting(spark, *paths, "10 minutes", "30 minutes").awaitTermination()
    return paths[1]


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, tmp_path):
    source = str(tmp_path / "in")
    first = [turn(c, n, 100 * c + n) for c in (1, 2) for n in (2, 0, 1)]
    write(spark, source, [*first, turn(None, 0, 5), turn(7, 0, None)])
    out = run(spark, tmp_path)
    assert sessions(spark, out) == [(1, ["1:0", "1:1", "1:2"])]
    # A turn in time for the open session of 2, a second session of 1, and one that moves time on.
    more = [turn(2, 3, 204), turn(1, 9, 260), turn(3, 0, 1000)]
    write(spark, source, more)
    assert run(spark, tmp_path) == out
    got = sessions(spark, out)
    assert got == [(1, ["1:0", "1:1", "1:2"]), (1, ["1:9"]), (2, ["2:0", "2:1", "2:2", "2:3"])]
    run(spark, tmp_path)  # nothing new: nothing is written twice
    assert sessions(spark, out) == got
    turns = spark.createDataFrame([t for t in [*first, *more] if t[0] == 2], TURNS_IN_TIME)
    batch = nest_turns(turns).rows.collect()
    assert [[m["content"] for m in r["messages"]] for r in batch] == [got[2][1]]


def test_late_turns_come_out_apart(spark, tmp_path):
    source = str(tmp_path / "in")
    write(spark, source, [turn(1, 0, 0), turn(1, 1, 1), turn(2, 0, 500)])
    out = run(spark, tmp_path)
    write(spark, source, [turn(1, 2, 2), turn(1, 1, 1), turn(3, 0, 1000)])
    run(spark, tmp_path)
    assert sessions(spark, out) == [(1, ["1:0", "1:1"]), (2, ["2:0"])]
    every = spark.read.schema(TURNS_IN_TIME).parquet(source)
    late = late_turns(every, spark.read.parquet(out), "2024-01-01 15:00:00")
    assert [(r["conv_id"], r["content"]) for r in late.collect()] == [(1, "1:2")]


def test_batch_table_has_all_sessions(spark):
    rows = [turn(1, n, n) for n in range(5)] + [turn(1, 5, 90)]
    got = nest_stream(spark.createDataFrame(rows, TURNS_IN_TIME), "1 minute", "10 minutes").collect()
    assert sorted(len(r["messages"]) for r in got) == [1, 5]
