"""Render and parse is the identity; what is no rendered text is refused."""

import random

import pytest
from pyspark.sql import functions as F

from turnloom.functions.parsing import parse_messages
from turnloom.functions.templates import template

ODD = ["", "q", " \n", "\n", "a \n", " \nb", "q <|im_start|>user \nmid <|im_end|> tail", "<|im_end|>", "é \U0001f642", "x\ny \n z"]
SPACED = "<|im_start|>user \nhi \n<|im_end|>\n"


@pytest.mark.parametrize("generation", [False, True])
@pytest.mark.parametrize("name", ["chatml_spaced", "chatml_compact"])
def test_render_and_parse_is_the_identity(spark, name, generation):
    rng = random.Random(2)
    rows = [
        (k, [(rng.choice(["user", "assistant", "tool", ""]), rng.choice(ODD)) for _ in range(rng.randrange(6))])
        for k in range(200)
    ]
    df = spark.createDataFrame(rows, "conv_id long, messages array<struct<role:string,content:string>>")
    text = template(name).text(df["messages"], generation)
    got = df.select("conv_id", text.alias("text")).withColumn("p", parse_messages(F.col("text"), name)).collect()
    want = dict(rows)
    assert len(got) == 200
    for r in got:
        assert [tuple(m) for m in r["p"]["messages"]] == want[r["conv_id"]]
        assert r["p"]["clear"] == (not any("<|im_" in c for _, c in want[r["conv_id"]]))


@pytest.mark.parametrize(
    "text, messages, clear",
    [
        (None, None, None),
        ("", [], True),
        ("hi", None, False),
        (SPACED, [("user", "hi")], True),
        (SPACED * 2000, [("user", "hi")] * 2000, True),
        (SPACED[:-1], None, False),
        ("x" + SPACED, None, False),
        ("<|im_start|>user hi \n<|im_end|>\n", None, False),
        ("<|im_start|> \n<|im_end|>\n", None, False),
        (SPACED + "<|im_start|>assistant\n", [("user", "hi")], True),
    ],
)
def test_edges(spark, text, messages, clear):
    df = spark.createDataFrame([(text,)], "text string")
    found = df.select(parse_messages(df["text"]).alias("p")).first()["p"]
    assert (None if found["messages"] is None else [tuple(m) for m in found["messages"]]) == messages
    assert found["clear"] is clear


def test_unknown_template(spark):
    with pytest.raises(KeyError):
        parse_messages(None, "instruct_folded")
