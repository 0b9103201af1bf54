import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from helpers import CONV_ROWS, preference_df, rows_of, texts
from turnloom import schemas as S
from turnloom.functions.templates import chatml_compact, chatml_spaced, instruct_folded
from turnloom.operators.nest import from_rows
from turnloom.operators.pairs import chat_format, plain_pairs
from turnloom.operators.render import render
from turnloom.plans import preference, sft, training_input
from turnloom.session import fresh_path, release, shared_dir
from turnloom.sources import adapters, readers, writers
from turnloom.streaming.rows import read_rows, run_rows

COLS = ("conv_id", "pair_idx", "prompt", "chosen", "rejected")
U, A = "user", "assistant"


@pytest.fixture
def pairs(spark):
    rows = [(c, 0, f"p{c} é\n", f"y{c} \"q\"", f"n{c}") for c in range(40)]
    return spark.createDataFrame(
        rows, "conv_id long, pair_idx long, prompt string, chosen string, rejected string"
    )


def test_jsonl_round_trip(spark, pairs, tmp_path):
    path = str(tmp_path / "pairs")
    writers.write_jsonl(chat_format(pairs), path)
    assert rows_of(plain_pairs(readers.read_pairs(spark, path)), *COLS) == rows_of(pairs, *COLS)
    line = json.loads(next(l for f in Path(path).glob("*.json") for l in f.read_text().splitlines()))
    assert list(line) == list(COLS) and list(line["prompt"][0]) == ["role", "content"]


def test_bad_lines_fail_or_are_kept(spark, tmp_path):
    good = '{"conv_id": 1, "source": "s", "chosen": [{"role": "u", "content": "c"}], "rejected": []}'
    for bad in ('{"conv_id": 2, "chosen": [', '{"conv_id": 2, "chosen": ["flat"]}', '{"conv_id": "x"}'):
        path = tmp_path / f"{abs(hash(bad))}.json"
        path.write_text(f"{good}\n{bad}\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            readers.read_preferences(spark, str(path), "json").collect()
        kept = readers.read_preferences(spark, str(path), "json", on_bad="keep").cache()
        assert kept.count() == 2
        assert [r["_corrupt_record"] for r in kept.collect() if r["_corrupt_record"]] == [bad]
    with pytest.raises(ValueError):
        readers.read_preferences(spark, str(path), "json", on_bad="other")


def test_string_keys_survive(spark, pairs, tmp_path):
    named = pairs.withColumn("conv_id", F.concat(F.lit("k"), "conv_id"))
    path = str(tmp_path / "pairs")
    writers.write_jsonl(chat_format(named), path)
    schema = S.keyed(S.CHAT_PAIRS, T.StringType())
    assert rows_of(plain_pairs(readers.read_pairs(spark, path, schema)), *COLS) == rows_of(named, *COLS)
    turns = spark.createDataFrame([("a", 0, "user", "x")], "conv_id string, turn long, role string, text string")
    turns.write.parquet(str(tmp_path / "turns"))
    assert readers.read_turns(spark, str(tmp_path / "turns")).first()["conv_id"] == "a"


def test_keys_from_files_are_stable(spark, tmp_path):
    rows = [("s", [("user", f"u{i}"), ("assistant", "a")], [("user", f"u{i}"), ("assistant", "b")]) for i in range(50)]
    path = str(tmp_path / "prefs")
    spark.createDataFrame(rows, S.keyless(S.PREFERENCES)).repartition(4).write.parquet(path)
    first, again = (
        rows_of(preference.pairs_from_rows(readers.read_preferences(spark, path)), "conv_id", "prompt")
        for _ in range(2)
    )
    assert first == again and len({k for k, _ in first}) == 50
    stored = readers.with_stored_key(spark.range(100).repartition(7).withColumnRenamed("id", "v"))
    assert stored.select("conv_id").distinct().count() == 100


def test_release_deletes_what_was_stored(spark):
    path = fresh_path(spark, "released")
    spark.range(3).write.parquet(path)
    other = f"{shared_dir(spark)}/not-ours"
    spark.range(3).write.mode("overwrite").parquet(other)
    assert release(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert spark.read.parquet(other).count() == 3


def test_jsonl_without_keys(pairs, tmp_path):
    path = str(tmp_path / "pairs")
    writers.write_jsonl(chat_format(pairs), path, drop=["conv_id", "pair_idx"])
    line = json.loads(next(l for f in Path(path).glob("*.json") for l in f.read_text().splitlines()))
    assert list(line) == ["prompt", "chosen", "rejected"]


def test_existing_output_is_not_overwritten(pairs, tmp_path):
    path = str(tmp_path / "pairs")
    writers.write_jsonl(pairs, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_jsonl(pairs, path)


def test_sft_plan_writes_train_and_eval(spark, tmp_path):
    root = str(tmp_path / "ds")
    nested = from_rows(spark.createDataFrame(CONV_ROWS, S.CONVERSATIONS))
    sft.prepare(nested, chatml_spaced(), root, n_eval=2)
    every = texts(render(nested, chatml_spaced()))
    kept = {k: v for k, v in every.items() if v is not None}
    assert texts(readers.read_dataset(spark, root, "train")) == kept
    assert set(texts(readers.read_dataset(spark, root, "eval"))) == {1}
    assert readers.read_dataset(spark, root, "eval").columns == ["conv_id", "text"]
    assert "split=eval" in {p.name for p in Path(root).iterdir()}


def test_preference_and_training_plans(spark, tmp_path):
    rows = [
        (c, None, [(U, f"u{c}"), (A, "a b c")], [(U, f"u{c}"), (A, f"r{c}")]) for c in range(20)
    ]
    path = str(tmp_path / "pairs")
    preference.prepare(preference.pairs_from_rows(preference_df(spark, rows)), path)
    chat = readers.read_pairs(spark, path)
    got = training_input.training_rows(
        chat, chatml_compact(), batch_size=2, accumulation=2, max_steps=5, budget=4
    )
    rows = got.collect()
    assert len(rows) == 20 and {(r["step"], r["slot"]) for r in rows} == {
        (s, i) for s in range(5) for i in range(4)
    }
    assert len({r["conv_id"] for r in rows}) == 14  # 70 % of 20
    for r in rows:
        whole = f"<|im_start|>user\nu{r['conv_id']}<|im_end|>\n<|im_start|>assistant\n"
        assert r["prompt"] == whole and r["chosen"] == whole + "a b c<|im_end|>\n"
        assert r["chosen_tokens"] == 6 and r["chosen_over"] and not r["rejected_over"]
        assert r["chosen_cut"] == whole + "a" and r["rejected_cut"] == r["rejected"]


def test_adapters(spark):
    df = spark.createDataFrame(
        [(1, [("human", "q"), ("gpt", "r"), ("tool", "t"), ("system", "s"), (None, "n")]), (2, None)],
        S.SHAREGPT,
    )
    got = {r["conv_id"]: r["messages"] for r in adapters.adapt(df, "sharegpt").collect()}
    assert [m["role"] for m in got[1]] == [U, A, "tool", "system", None] and got[2] is None
    again = adapters.adapt(adapters.adapt(df, "sharegpt"), "role_content")
    assert {r["conv_id"]: r["messages"] for r in again.collect()} == got
    own = adapters.adapt(
        df, lambda d: d.select("conv_id", F.array(S.message(F.lit(U), F.lit("x"))).alias("messages"))
    )
    assert texts(render(from_rows(own), instruct_folded())) == {1: "[INST] x [/INST]", 2: "[INST] x [/INST]"}


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "x")], "conv_id long, messages string")
    with pytest.raises(S.SchemaError, match="messages"):
        S.check_columns(df, S.CONVERSATIONS)
    with pytest.raises(S.SchemaError, match="missing column"):
        adapters.adapt(df, lambda d: d.drop("messages"))


def test_declared_json_schema_keeps_field_order(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text(
        json.dumps({"conv_id": 1, "messages": [{"content": "c", "role": "user"}]}) + "\n"
    )
    df = readers.read_conversations(spark, str(path), fmt="json")
    assert df.schema == S.CONVERSATIONS
    with pytest.raises(ValueError):
        readers.read_conversations(spark, str(path), fmt="csv")


def test_fresh_paths_are_below_the_shared_folder(spark):
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark).rstrip("/"))


def test_stream_of_rows_continues(spark, tmp_path):
    source, out, marks = tmp_path / "in", tmp_path / "out", tmp_path / "marks"
    source.mkdir()

    def operator(df):
        return render(from_rows(adapters.from_sharegpt(df)), chatml_spaced()).filter("text is not null")

    def arrive(name, *rows):
        lines = [json.dumps({"conv_id": c, "conversations": m}) for c, m in rows]
        (source / name).write_text("\n".join(lines))
        stream = read_rows(spark, str(source), S.SHAREGPT)
        run_rows(stream, operator, str(out), str(marks)).awaitTermination(120)
        return texts(spark.read.parquet(str(out)))

    say = [{"from": "human", "value": "q"}]
    want = "<|im_start|>user \nq \n<|im_end|>\n"
    assert arrive("a.json", (1, say), (2, None)) == {1: want}
    assert arrive("b.json", (3, say)) == {1: want, 3: want}
    assert spark.read.parquet(str(out)).count() == 2


def test_stream_of_preferences(spark, tmp_path):
    source = tmp_path / "in"
    row = {
        "conv_id": 1,
        "source": None,
        "chosen": [{"role": U, "content": "u"}, {"role": A, "content": "a"}],
        "rejected": [{"role": U, "content": " u"}, {"role": A, "content": "b"}],
    }
    source.mkdir()
    (source / "a.json").write_text(json.dumps(row))
    stream = read_rows(spark, str(source), S.PREFERENCES)
    out = str(tmp_path / "out")
    run_rows(stream, preference.pairs_from_rows, out, str(tmp_path / "m")).awaitTermination(120)
    assert rows_of(spark.read.parquet(out), *COLS) == [(1, 0, "u", "a", "b")]
