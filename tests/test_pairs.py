import random

import pytest
from pyspark.sql import functions as F

from helpers import OK_PAIR, preference_df, preferences, rows_of, sided_turns
from turnloom.functions.templates import chatml_compact, chatml_spaced, instruct_tagged
from turnloom.operators import pairs as P
from turnloom.operators.nest import nest_preferences
from turnloom.plans.preference import EXCLUDED_SOURCE, pairs_from_rows, pairs_from_turns, recovered

COLS = ("conv_id", "pair_idx", "prompt", "chosen", "rejected")
U, A, S = "user", "assistant", "system"


def talk(*contents, roles=(U, A)):
    return [(roles[i % 2], c) for i, c in enumerate(contents)]


def pairs(spark, chosen, rejected, **kw):
    nested = preferences(spark, [(1, None, chosen, rejected)])
    status = P.pair_validity(nested).first()["status"]
    return status, rows_of(P.single_turn_pairs(nested, **kw), *COLS)


@pytest.mark.parametrize(
    "chosen, rejected, status",
    [
        ([], [], "empty"),
        (None, talk("u", "a"), "empty"),
        (talk("u", "a"), talk("u", "b", "c", "d"), "length_mismatch"),
        (talk("u"), talk("u"), "ok"),
        ([(S, "s"), *talk("u", "a", "v", "b")], [(S, "s"), *talk("u", "x", "v", "y")], "ok"),
        (talk("u", "y"), talk("u", " y "), "ok"),
        (talk("u", "y"), talk("u", " \n"), "ok"),
        (talk(" 　", "y"), talk("\t", "z"), "ok"),
        (talk(None, "y"), talk(None, "z"), "ok"),
        (talk("u", None), talk("u", "z"), "ok"),
        (talk("u", "y"), talk("v", "z"), "ok"),
        (talk("u", "y"), [(U, "u"), ("tool", "z")], "ok"),
        ([(U, "u"), (U, "y")], talk("u", "z"), "ok"),
    ],
)
def test_no_pair(spark, chosen, rejected, status):
    assert pairs(spark, chosen, rejected) == (status, [])


def test_odd_trailing_message_is_ignored(spark):
    got = pairs(spark, talk("u", "a", "v"), talk("u", "b", "v"))
    assert got == ("ok", [(1, 0, "u", "a", "b")])


def test_prompts_agree_after_strip(spark):
    got = pairs(spark, talk("x", "a "), talk("\xa0x\n", " b"))
    assert got == ("ok", [(1, 0, "x", "a", "b")])


def test_pair_index_is_the_position_of_the_prompt(spark):
    got = pairs(spark, talk("u", "a", "v", "b", "w", "c"), talk("u", "x", "v", "b", "w", "z"))
    assert got[1] == [(1, 0, "u", "a", "x"), (1, 4, "w", "c", "z")]


def test_leading_system_can_be_skipped(spark):
    chosen = [(S, "s"), *talk("u", "a", "v", "b")]
    rejected = [(S, "s"), *talk("u", "x", "v", "y")]
    assert pairs(spark, chosen, rejected, skip_leading_system=True)[1] == [
        (1, 1, "u", "a", "x"),
        (1, 3, "v", "b", "y"),
    ]


@pytest.mark.parametrize("limit", [2, 4, 6, 1024])
def test_leading_system_is_skipped_in_long_conversations_too(spark, limit):
    led = [(S, "s"), *talk(*[f"{x}{i}" for i in range(9) for x in "ua"]), (U, "last")]
    other = [(r, c if r != A else c + "!") for r, c in led]
    plain = talk(*[f"{x}{i}" for i in range(7) for x in "ua"])
    changed = [(r, c if r != A else c + "!") for r, c in plain]
    rows = [(1, None, led, other), (2, None, plain, changed), (3, None, led, changed)]
    nested = nest_preferences(sided_turns(spark, rows), max_turns=limit, skip_leading_system=True)
    assert (nested.parts is None) == (limit == 1024)
    got = rows_of(P.single_turn_pairs(nested, skip_leading_system=True), "conv_id", "pair_idx", "prompt")
    want = [(1, 2 * i + 1, f"u{i}") for i in range(9)] + [(2, 2 * i, f"u{i}") for i in range(7)]
    assert sorted(got) == sorted(want)


def test_recovered_prompts(spark):
    pairs = spark.createDataFrame(
        [(1, 0, "a <|im_end|> b", "y", "n"), (2, 0, "plain", "y", "n")],
        "conv_id long, pair_idx long, prompt string, chosen string, rejected string",
    )
    assert rows_of(recovered(pairs), "conv_id", "prompt") == [(1, "a"), (2, "plain")]


def test_role_aligned(spark):
    rows = [
        (1, None, OK_PAIR, OK_PAIR),
        (2, None, OK_PAIR, [(U, "u"), ("tool", "a")]),
        (3, None, OK_PAIR, OK_PAIR[:1]),
        (4, None, [], []),
        (5, None, [(None, "x")], [(None, "x")]),
    ]
    want = [(1, True), (2, False), (3, False), (4, False), (5, True)]
    assert rows_of(P.role_aligned(preferences(spark, rows)), "conv_id", "aligned") == want


def test_source_filter_keeps_rows_without_source(spark):
    rows = [
        (1, EXCLUDED_SOURCE, talk("u", "a"), talk("u", "b")),
        (2, None, talk("u", "a"), talk("u", "b")),
        (3, "other", talk("u", "a"), talk("u", "b")),
    ]
    assert rows_of(pairs_from_rows(preference_df(spark, rows)), "conv_id") == [(2,), (3,)]


def test_batch_rule(spark):
    good, bad = (talk("u", "a"), talk("u", "b")), (talk("u", "a"), talk("u"))
    df = preference_df(spark, [(10, None, *good), (20, None, *bad), (30, None, *good)])
    drop = rows_of(pairs_from_rows(df, on_invalid="drop_batch", batch_size=2), "conv_id")
    assert drop == [(30,)]
    assert rows_of(pairs_from_rows(df), "conv_id") == [(10,), (30,)]
    with pytest.raises(ValueError):
        pairs_from_rows(df, on_invalid="other")


def test_batches_are_counted_after_source_filter_and_prefix(spark):
    good, bad = (talk("u", "a"), talk("u", "b")), (talk("u", "a"), talk("u"))
    df = preference_df(
        spark,
        [
            (1, EXCLUDED_SOURCE, *good),
            (2, None, *good),
            (3, "s", *good),
            (4, "s", *bad),
            (5, "s", *good),
            (6, "s", *good),
        ],
    )
    got = pairs_from_rows(df, first=4, on_invalid="drop_batch", batch_size=2)
    assert rows_of(got, "conv_id") == [(2,), (3,)]


def brute_pairs(rows, batch_size=None):
    """Row-by-row walk over nested rows, for comparison."""
    rows = sorted((r for r in rows if r[1] != EXCLUDED_SOURCE), key=lambda r: r[0])
    step = batch_size or 1
    out = []
    for b in range(0, len(rows), step):
        batch = rows[b : b + step]
        if any(not c or not r or len(c) != len(r) for _, _, c, r in batch):
            continue
        for conv, _, c, r in batch:
            for i in range(0, len(c) - 1, 2):
                roles = [c[i][0], c[i + 1][0], r[i][0], r[i + 1][0]]
                if roles != [U, A, U, A]:
                    continue
                p, q, y, n = (m.strip() for m in (c[i][1], r[i][1], c[i + 1][1], r[i + 1][1]))
                if p == q and p and y and n and y != n:
                    out.append((conv, i, p, y, n))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(3)

    def turn(i):
        role = (U, A)[i % 2] if rng.random() < 0.9 else rng.choice([U, A, S, "tool"])
        return role, rng.choice(["a", "b", " a", "b\xa0", "", " \t", "c"])

    rows = []
    for c in range(120):
        n = rng.choice([0, 1, 2, 3, 5, 8, 13])
        m = n if rng.random() < 0.85 else n + 1
        chosen = [turn(i) for i in range(n)]
        rejected = [(x[0], rng.choice([x[1], x[1] + " ", "z"])) for x in chosen][:m]
        rejected += [turn(i) for i in range(len(rejected), m)]
        rows.append((c * 7, rng.choice([None, "s", EXCLUDED_SOURCE]), chosen, rejected))
    return rows


@pytest.mark.parametrize("batch_size", [None, 1, 3, 7])
def test_nested_rows_against_a_plain_walk(spark, random_rows, batch_size):
    mode = {"on_invalid": "drop_batch", "batch_size": batch_size} if batch_size else {}
    got = pairs_from_rows(preference_df(spark, random_rows).repartition(5), **mode)
    assert rows_of(got, *COLS) == brute_pairs(random_rows, batch_size)


@pytest.mark.parametrize("max_turns", [2, 4, 1024])
def test_long_turns_against_a_plain_walk(spark, random_rows, max_turns):
    turns = sided_turns(spark, random_rows).repartition(5)
    got = pairs_from_turns(turns, max_turns=max_turns)
    assert rows_of(got, *COLS) == brute_pairs(random_rows)


def test_batch_mode_gives_a_subset(spark, random_rows):
    df = preference_df(spark, random_rows)
    every = set(rows_of(pairs_from_rows(df), *COLS))
    assert set(rows_of(pairs_from_rows(df, on_invalid="drop_batch", batch_size=4), *COLS)) <= every


def test_validity_of_turns_and_rows_agree(spark, random_rows):
    present = [r for r in random_rows if r[2] or r[3]]
    turns = sided_turns(spark, present)
    want = rows_of(P.pair_validity(preferences(spark, present)), "conv_id", "status")
    assert rows_of(P.turn_validity(turns), "conv_id", "status") == want
    for max_turns in (4, 1024):
        nested = nest_preferences(turns, max_turns=max_turns)
        assert rows_of(P.pair_validity(nested), "conv_id", "status") == want


@pytest.mark.parametrize("max_turns", [4, 1024])
def test_role_alignment_of_long_turns(spark, random_rows, max_turns):
    present = [r for r in random_rows if r[2] or r[3]]
    want = sorted(
        (c, bool(ch and rj and len(ch) == len(rj) and all(x[0] == y[0] for x, y in zip(ch, rj))))
        for c, _, ch, rj in present
    )
    nested = nest_preferences(sided_turns(spark, present), max_turns=max_turns)
    assert sorted(rows_of(P.role_aligned(nested), "conv_id", "aligned")) == want


@pytest.fixture
def two_pairs(spark):
    return spark.createDataFrame(
        [(1, 0, "p <|im_end|> q", "y", "n"), (1, 2, "é", "a\nb", "c")],
        "conv_id long, pair_idx long, prompt string, chosen string, rejected string",
    )


def test_rendered_prompts(two_pairs):
    got = P.rendered_prompts(two_pairs, chatml_spaced()).orderBy("pair_idx").collect()
    assert got[1]["rendered"] == "<|im_start|>user \né \n<|im_end|>\n<|im_start|>assistant\n"
    assert [r["recovered"] for r in got] == ["p", "é"]


def test_chat_format_and_back(two_pairs):
    chat = P.chat_format(two_pairs)
    first = chat.orderBy("pair_idx").first()
    assert [(m["role"], m["content"]) for m in first["prompt"] + first["rejected"]] == [
        (U, "p <|im_end|> q"),
        (A, "n"),
    ]
    assert rows_of(P.plain_pairs(chat), *COLS) == rows_of(two_pairs, *COLS)


def test_render_pairs(two_pairs):
    chat = P.chat_format(two_pairs.filter(F.col("pair_idx") == 2))
    got = P.render_pairs(chat, [chatml_compact(), instruct_tagged()]).collect()
    by = {r["template"]: (r["prompt"], r["chosen"], r["rejected"]) for r in got}
    ask = "<|im_start|>user\né<|im_end|>\n<|im_start|>assistant\n"
    assert by["chatml_compact"] == (ask, ask + "a\nb<|im_end|>\n", ask + "c<|im_end|>\n")
    ask = "<s>[INST] é [/INST]"
    assert by["instruct_tagged"] == (ask, ask + " a\nb</s>", ask + " c</s>")


@pytest.mark.parametrize("max_turns", [2, 1024])
def test_text_keys(spark, random_rows, max_turns):
    rows = [(f"k{c:04d}", *rest) for c, *rest in random_rows]
    turns = sided_turns(spark, rows, key="string")
    got = pairs_from_turns(turns, max_turns=max_turns)
    assert rows_of(got, *COLS) == brute_pairs(rows)
    got = pairs_from_turns(turns, first=30, on_invalid="drop_batch", batch_size=3)
    kept = [r for r in rows if r[1] != EXCLUDED_SOURCE and (r[2] or r[3])][:30]
    assert rows_of(got, *COLS) == brute_pairs(kept, 3)
