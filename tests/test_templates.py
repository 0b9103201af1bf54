import random

import pytest
from pyspark.sql import functions as F

from helpers import conversations, texts, turns_of
from turnloom.functions.folds import BLOCK, fold_list
from turnloom.functions.templates import TEMPLATES, template
from turnloom.operators.nest import nest_turns
from turnloom.operators.prompts import clean_response, instruct_prompts, prompt_grid
from turnloom.operators.render import render, render_parts
from turnloom.operators.select import drop_null
from turnloom.operators.shaping import completion_spans

SYS, USR, AST = "system", "user", "assistant"
CASES = {
    1: [(SYS, "S"), (USR, "U"), (AST, "A")],
    2: [(SYS, "S1"), (SYS, "S2"), (USR, "U"), (AST, "A")],
    3: [(SYS, ""), (USR, "U")],
    4: [(USR, "U"), (SYS, "Z")],
    5: [(USR, "U"), ("tool", "T"), (AST, "A")],
    6: [],
    7: [(USR, None)],
    8: None,
    9: [(AST, "A"), (USR, "U1"), (USR, "U2")],
    10: [("tool", None), (USR, "U")],
    11: [(None, "x"), (USR, "U")],
    12: [(SYS, "S"), (AST, "A"), (USR, "U1"), (USR, "U2")],
}
WANT = {
    "instruct_folded": {
        1: "[INST] S\nU [/INST]A</s>",
        2: "[INST] S2\nU [/INST]A</s>",
        3: "[INST] \nU [/INST]",
        4: "[INST] U [/INST]",
        5: "[INST] U [/INST]A</s>",
        6: "",
        7: None,
        8: None,
        9: "A</s>[INST] U1 [/INST][INST] U2 [/INST]",
        10: "[INST] U [/INST]",
        11: "[INST] U [/INST]",
        12: "A</s>[INST] S\nU1 [/INST][INST] U2 [/INST]",
    },
    "instruct_tagged": {
        1: "<s>[SYSTEM_PROMPT] S [/SYSTEM_PROMPT][INST] U [/INST] A</s>",
        2: "<s>[SYSTEM_PROMPT] S1 [/SYSTEM_PROMPT][SYSTEM_PROMPT] S2 [/SYSTEM_PROMPT]"
        "[INST] U [/INST] A</s>",
        3: "<s>[SYSTEM_PROMPT]  [/SYSTEM_PROMPT][INST] U [/INST]",
        4: "<s>[INST] U [/INST][SYSTEM_PROMPT] Z [/SYSTEM_PROMPT]",
        5: "<s>[INST] U [/INST] A</s>",
        6: "<s>",
        7: None,
        8: None,
        9: "<s> A</s>[INST] U1 [/INST][INST] U2 [/INST]",
        10: "<s>[INST] U [/INST]",
        11: "<s>[INST] U [/INST]",
        12: "<s>[SYSTEM_PROMPT] S [/SYSTEM_PROMPT] A</s>[INST] U1 [/INST][INST] U2 [/INST]",
    },
}
for name, frame in {
    "chatml_spaced": "<|im_start|>{} \n{} \n<|im_end|>\n",
    "chatml_compact": "<|im_start|>{}\n{}<|im_end|>\n",
}.items():
    WANT[name] = {
        k: None
        if ms is None or any(None in m for m in ms)
        else "".join(frame.format(*m) for m in ms)
        for k, ms in CASES.items()
    }


@pytest.mark.parametrize("name", TEMPLATES)
def test_edge_rows(spark, name):
    assert texts(render(conversations(spark, CASES), template(name))) == WANT[name]


def test_null_texts_are_dropped_and_empty_ones_kept(spark):
    kept = texts(drop_null(render(conversations(spark, CASES), template("instruct_folded"))))
    assert set(kept) == set(CASES) - {7, 8} and kept[6] == ""


def test_generation_suffix(spark):
    one = conversations(spark, {1: [(USR, "U")]})
    assert texts(render(one, template("chatml_spaced"), True))[1].endswith("<|im_start|>assistant\n")
    plain = texts(render(one, template("instruct_tagged"), False))
    assert texts(render(one, template("instruct_tagged"), True)) == plain


def test_settings_and_unknown_template(spark):
    t = template("instruct_tagged", bos="<b>", eos="<e>")
    assert texts(render(conversations(spark, {1: [(AST, "A")]}), t)) == {1: "<b> A<e>"}
    with pytest.raises(KeyError):
        template("none")


@pytest.fixture(scope="module")
def random_talks():
    rng = random.Random(7)
    roles = [USR, AST, SYS, "tool"]
    talks = {
        c: [(rng.choice(roles), f"c{c} é{t}") for t in range(rng.choice([1, 3, 4, 9, 14]))]
        for c in range(30)
    }
    talks[30] = [(rng.choice(roles), f"long {t}") for t in range(61)]
    talks[31] = [(USR, "x")] * 9 + [(USR, None)]
    talks[32] = [(SYS, "far")] + [(AST, f"a{t}") for t in range(12)] + [(USR, "end")]
    return talks


@pytest.mark.parametrize("name", TEMPLATES)
def test_parts_render_as_the_whole(spark, random_talks, name):
    turns = turns_of(spark, random_talks)
    whole = nest_turns(turns)
    assert whole.parts is None
    want = texts(render(whole, template(name), True))
    nested = nest_turns(turns, max_turns=4)
    assert nested.parts is not None
    assert texts(render(nested, template(name), True)) == want
    sizes = nested.rows.select(F.size("messages").alias("n"), (F.col("first_pos") % 4).alias("m"))
    assert {r["m"] for r in sizes.collect()} == {0} and sizes.agg(F.max("n")).first()[0] == 4


def test_turns_without_a_key(spark, random_talks):
    """They are dropped or refused, be they few or many."""
    named = turns_of(spark, {1: random_talks[30]})
    nameless = named.withColumn("conv_id", F.lit(None).cast("long"))
    for limit in (4, 1024, None):
        nested = nest_turns(named.unionByName(nameless), max_turns=limit)
        assert texts(render(nested, template("chatml_spaced"))).keys() == {1}
        with pytest.raises(Exception, match="has no conv_id"):
            nest_turns(named.unionByName(nameless), max_turns=limit, null_key="refuse").rows.collect()


def test_parts_are_a_result_of_their_own(spark, random_talks):
    nested = nest_turns(turns_of(spark, {30: random_talks[30]}), max_turns=8)
    parts = render_parts(nested.parts, template("instruct_folded")).orderBy("first_pos").collect()
    assert len(parts) == 8
    want = texts(render(conversations(spark, {30: random_talks[30]}), template("instruct_folded")))
    assert "".join(p["part"] for p in parts) == want[30]


@pytest.mark.parametrize("max_turns", [4, 1024])
@pytest.mark.parametrize("name", ["chatml_spaced", "chatml_compact"])
def test_spans_cut_out_assistant_contents(spark, random_talks, name, max_turns):
    nested = nest_turns(turns_of(spark, random_talks), max_turns=max_turns)
    t = template(name)
    text = texts(render(nested, t))
    got = {
        (r["conv_id"], r["turn"]): text[r["conv_id"]][r["start_pos"] : r["end_pos"]]
        for r in completion_spans(nested, t).collect()
    }
    assert got == {
        (c, i): content
        for c, ms in random_talks.items()
        if text[c] is not None
        for i, (role, content) in enumerate(ms)
        if role == AST
    }


def test_spans_need_a_fixed_frame(spark):
    with pytest.raises(ValueError):
        completion_spans(conversations(spark, CASES), template("instruct_folded"))


@pytest.mark.parametrize("n", [0, 1, BLOCK, BLOCK + 1, 3 * BLOCK + 5])
def test_fold_list_matches_a_plain_loop(spark, n):
    xs = F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>")
    folded = fold_list(xs, F.lit(0), lambda s, x: s * 2 + x, lambda s, x: (s + x) % 101, "int")
    state, want = 0, []
    for x in range(1, n + 1):
        want.append(state * 2 + x)
        state = (state + x) % 101
    assert spark.range(1).select(folded).first()[0] == want


def test_instruct_prompts(spark):
    talks = {
        1: [(USR, "q1"), (SYS, "s1"), (USR, "q2"), (SYS, "s2")],
        2: [(AST, "a"), (USR, "q")],
        3: [(SYS, "s")],
        4: [(SYS, None), (USR, "q")],
    }
    assert texts(instruct_prompts(turns_of(spark, talks))) == {
        1: "<s>[INST] s1\nq1 [/INST]",
        2: "<s>[INST] q [/INST]",
        3: None,
        4: "<s>[INST] q [/INST]",
    }


def test_prompt_grid(spark):
    qs = spark.createDataFrame([(1, "a"), (2, "b")], "id long, q string")
    got = prompt_grid(qs, "id", "q", [(0, "S0"), (1, "S1")], template("chatml_compact")).collect()
    frame = "<|im_start|>system\n{}<|im_end|>\n<|im_start|>user\n{}<|im_end|>\n<|im_start|>assistant\n"
    assert {(r["question_id"], r["system_id"]): r["prompt"] for r in got} == {
        (i, s): frame.format(f"S{s}", q) for i, q in [(1, "a"), (2, "b")] for s in (0, 1)
    }


@pytest.mark.parametrize("skip, want", [(True, "yes  no"), (False, "yes <|im_end|> no<|im_end|>")])
def test_clean_response(spark, skip, want):
    prompt = "<|im_start|>user\nsüß?<|im_end|>\n"
    output = prompt + " \xa0yes <|im_end|> no<|im_end|>\n"
    df = spark.createDataFrame([(prompt, output)], "p string, o string")
    got = df.select(clean_response(F.col("o"), F.col("p"), skip_special=skip)).first()[0]
    assert got == want
