"""Shared by the tests: literal tables, and comparison with DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb

from turnloom import schemas as S
from turnloom.operators.nest import from_rows, preference_rows

OK_PAIR = [("user", "u"), ("assistant", "a")]


def conversations(spark, rows):
    """``rows``: {conv_id: list of (role, content) or None}."""
    return from_rows(spark.createDataFrame(list(rows.items()), S.CONVERSATIONS))


def preference_df(spark, rows):
    """``rows``: list of (conv_id, source, chosen, rejected)."""
    return spark.createDataFrame(rows, S.PREFERENCES)


def preferences(spark, rows):
    return preference_rows(preference_df(spark, rows))


def turns_of(spark, rows):
    """Long turns of ``{conv_id: list of (role, content)}``."""
    long = [(c, t, r, x) for c, ms in rows.items() for t, (r, x) in enumerate(ms)]
    return spark.createDataFrame(long, S.TURNS)


def sided_turns(spark, rows, key="long"):
    """Long two-sided turns of (conv_id, source, chosen, rejected) rows."""
    long = [
        (c, src, side, t, r, x)
        for c, src, *lists in rows
        for side, ms in zip(("chosen", "rejected"), lists)
        for t, (r, x) in enumerate(ms or [])
    ]
    return spark.createDataFrame(
        long, f"conv_id {key}, source string, side string, turn long, role string, content string"
    )


def texts(df):
    return {r["conv_id"]: r["text"] for r in df.collect()}


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def duck(data_dir):
    con = duckdb.connect()
    for f in Path(data_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def assert_same(df, con, sql):
    """Same column names and the same rows, whatever their order."""
    got, cols = df.collect(), sorted(df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    place = [names.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in place) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in got), key=repr) == want
    return len(want)


CONV_ROWS = [
    (1, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    (2, None),
    (3, [("user", None)]),
    (4, [("tool", "t")]),
    (5, []),
]
