"""Token counts against merges done by hand and against another library's encoder."""

import base64
import random
from pathlib import Path

import pytest
import regex

from turnloom.operators import tokens as K
from turnloom.operators.shaping import length_budget

FILES = Path("/opt/tokenizers")
TEXTS = [None, "", " ", "Hello world, it's here", "naïve café \U0001f642\U0001f642 ok", "a" * 5000, "\n\n  x\t\t", "<|endoftext|>", "日本語のテキスト", "1234567 don't"]


def plain_bpe(text, ranks):
    """Byte pairs merged one at a time, the pair of the lowest rank first."""
    out = []
    for word in regex.findall(K.WORDS, text):
        parts = [bytes([b]) for b in word.encode()]
        while len(parts) > 1:
            rank, k = min((ranks.get(a + b, 1 << 40), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 40:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        out += parts
    return out


@pytest.fixture(scope="module")
def small_vocabulary(tmp_path_factory):
    """Single bytes and some merges, made here."""
    made = [bytes([b]) for b in range(256)]
    made += [b"ab", b" a", b"bc", b"abc", b"he", b"ll", b"hell", b" w", b"or", b"\xc3\xa9", b"aa", b"aaaa"]
    path = tmp_path_factory.mktemp("ranks") / "small.ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate(made)))
    return str(path), {t: k for k, t in enumerate(made)}


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def test_counts_and_cuts_equal_plain_merges(spark, small_vocabulary):
    path, ranks = small_vocabulary
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("abc hélow\n") for _ in range(rng.randrange(60))) for _ in range(200)]
    got = K.token_budget(table(spark, texts).repartition(3), K.Tokens(spark, path), 7).collect()
    assert len(got) == len(texts)
    for r in got:
        if r["text"] is None:
            assert r["n_tokens"] is None and r["cut_text"] is None and r["over_budget"] is None
            continue
        want = plain_bpe(r["text"], ranks)
        kept = b"".join(want[:7]).decode("utf-8", errors="ignore")
        assert (r["n_tokens"], r["over_budget"], r["cut_text"]) == (len(want), len(want) > 7, kept)


def test_counts_equal_another_encoder(spark, sf_dir):
    if not FILES.exists():
        pytest.skip("no vocabulary files")
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(str(FILES / "byte_bpe_50k.json"))
    other.encode_special_tokens = True
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").unionByName(table(spark, TEXTS[1:]).select("text"))
    tokens = K.Tokens(spark, str(FILES / "byte_bpe_50k.tiktoken"))
    rows = docs.select("text", tokens.count(docs["text"]).alias("n")).filter("text is not null").collect()
    want = [len(e.ids) for e in other.encode_batch([r["text"] for r in rows], add_special_tokens=False)]
    assert [r["n"] for r in rows] == want and len(rows) > 900


def test_length_budget_takes_true_counts(spark, small_vocabulary):
    tokens = K.Tokens(spark, small_vocabulary[0])
    df = table(spark, ["hello there you", "ab"])
    counted = df.withColumn("true", tokens.count(df["text"]))
    got = {r["id"]: (r["n_tokens"], r["over_budget"], r["cut_text"]) for r in length_budget(counted, 2, token_count_col="true").collect()}
    assert got[0][0] == len(plain_bpe("hello there you", small_vocabulary[1])) and got[0][1:] == (True, "hello there")
    assert got[1] == (1, False, "ab")


def test_empty_tables_clashes_and_plan(spark, small_vocabulary):
    tokens = K.Tokens(spark, small_vocabulary[0])
    df = spark.createDataFrame([("ab ab", 9, "x", "y")], "text string, n_tokens int, cut_text string, _measured string")
    out = K.token_budget(df, tokens, 1)
    assert [r.asDict() for r in out.collect()] == [
        {"text": "ab ab", "n_tokens": 3, "cut_text": "ab", "_measured": "y", "over_budget": True}
    ]
    assert K.token_budget(df.limit(0), tokens).collect() == []
    assert K.token_budget(df, tokens, 0).first()["cut_text"] == ""
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        K.token_budget(df, tokens, -1)


def test_vocabulary_is_checked(spark, tmp_path, monkeypatch, small_vocabulary):
    bad = tmp_path / "bad.ranks"
    bad.write_text("YQ== 0\nYg== 0\n")
    with pytest.raises(ValueError, match="rank each"):
        K.read_ranks(spark, str(bad))
    bad.write_text("YQ== 0\nYg== 1\n")
    with pytest.raises(ValueError, match="single bytes"):
        K.read_ranks(spark, str(bad))
    monkeypatch.setattr(K, "MAX_TOKENS", 10)
    with pytest.raises(ValueError, match="more than 10"):
        K.read_ranks(spark, small_vocabulary[0])
