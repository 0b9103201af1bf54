import sys

import pytest
from pyspark.sql import functions as F

from turnloom.functions.templates import recover_prompt
from turnloom.functions.text import WHITESPACE, count_tokens, first_tokens, strip


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x"))).first()[0]


def test_whitespace_is_all_that_python_strips():
    assert set(WHITESPACE) == {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()}


def test_strip_each_code_point(spark):
    rows = [(f"{c}a{c}b{c}",) for c in WHITESPACE] + [("​a​",), ("",), (WHITESPACE,)]
    got = spark.createDataFrame(rows, "x string").select("x", strip(F.col("x")).alias("y")).collect()
    assert all(r["y"] == r["x"].strip() for r in got)


@pytest.mark.parametrize(
    "rendered, want",
    [
        ("<|im_start|>user \nhi \n<|im_end|>\n<|im_start|>assistant\n", "hi"),
        ("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n", "<|im_start|>user\nhi"),
        ("<|im_start|>user \na<|im_end|>b \n<|im_end|>\n", "a"),
        ("<|im_start|>user \na<|im_start|>user \nb \n<|im_end|>\n", "b"),
        ("no marks ", "no marks"),
    ],
)
def test_recover_prompt(spark, rendered, want):
    assert one(spark, recover_prompt, rendered) == want


def test_first_tokens(spark):
    text = "  one two\n\nthree\tfour  "
    assert one(spark, count_tokens, text) == 4
    for n, want in [(0, ""), (1, "  one"), (3, "  one two\n\nthree"), (9, "  one two\n\nthree\tfour")]:
        assert one(spark, lambda x: first_tokens(x, n), text) == want


def test_first_tokens_of_a_very_long_text(spark):
    words = [f"w{i}" for i in range(300_000)]
    assert one(spark, lambda x: first_tokens(x, 200_000), " ".join(words)) == " ".join(words[:200_000])
