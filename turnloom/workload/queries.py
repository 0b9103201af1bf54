"""Registered queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from turnloom.functions.parsing import parse_messages
from turnloom.functions.templates import (
    Template,
    chatml_compact,
    chatml_spaced,
    instruct_folded,
    instruct_tagged,
)
from turnloom.functions.text import count_tokens
from turnloom.operators import pairs as P
from turnloom.operators.metrics import preference_metrics as metrics
from turnloom.operators.nest import Nested, from_rows, nest_preferences, nest_turns
from turnloom.operators.packing import least_bins, pack_sequences as pack
from turnloom.operators.prompts import clean_response, instruct_prompts, prompt_grid as grid
from turnloom.operators.render import render
from turnloom.operators.select import (
    drop_null,
    exclude_source,
    stage_counts,
    take_prefix as prefix,
)
from turnloom.operators.shaping import (
    completion_spans as spans,
    length_budget as budget,
    step_plan as plan,
)
from turnloom.operators.splits import (
    balanced_sample as sample,
    exact_split as split_exactly,
    overlap_audit,
    prefix_split,
)
from turnloom.operators.tokens import Tokens, token_budget as cut_to_budget
from turnloom.operators.units import leak_free_split as split_units_apart, split_units
from turnloom.plans import preference, sft, training_input
from turnloom.plans.preference import EXCLUDED_SOURCE, pairs_from_turns
from turnloom.schemas import CHAT_PAIRS, SHAREGPT, keyless
from turnloom.session import fresh_path, shared_dir
from turnloom.sources.adapters import adapt, turns_from_sharegpt
from turnloom.sources.readers import (
    read_conversations,
    read_dataset,
    read_pairs,
    read_preferences,
    with_stored_key,
)
from turnloom.sources.writers import write_jsonl, write_splits
from turnloom.streaming.nesting import run_nesting
from turnloom.workload import views

Query = Callable[[SparkSession, str], DataFrame]

KEYS = ["conv_id", "pair_idx"]
EVAL_PREFIX = 40
TRUE_BUDGET = 256
# A public vocabulary, read by Spark; a path of the deployment.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PREFIX = 50
BATCH = 5
PER_LANG = 20
MANY_PER_LANG = 1200
DOCUMENT_PREFIX = 300
TOKEN_BUDGET = 256
PACK_BUDGET = 1024
PAIR_BUDGET = 64


def role_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns_from_sharegpt(views.sharegpt_turns(spark, sf_dir))
    return rows.select("conv_id", "turn", "role", "content")


def _text(template: Callable[[], Template], generation: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        nested = nest_turns(views.turns(spark, sf_dir))
        return drop_null(render(nested, template(), generation))

    return query


def sft_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sft.texts(views.turns_with_gaps(spark, sf_dir), chatml_spaced())


def sft_sharegpt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sft.texts(turns_from_sharegpt(views.sharegpt_turns(spark, sf_dir)), chatml_spaced())


def inst_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruct_prompts(views.turns(spark, sf_dir))


def take_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = exclude_source(views.sources(spark, sf_dir), EXCLUDED_SOURCE)
    return prefix(kept, "conv_id", PREFIX).select("conv_id")


def sft_eval_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = views.turns(spark, sf_dir).select("conv_id").distinct()
    return prefix_split(ids, "conv_id", EVAL_PREFIX)


def tail_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sft.preview(views.turns_with_late_gaps(spark, sf_dir), chatml_spaced())


def _split_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nest_turns(views.turns(spark, sf_dir))
    return sft.split_texts(nested, chatml_spaced(), EVAL_PREFIX)


def train_eval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_audit(_split_texts(spark, sf_dir), "conv_id")


def document_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of split over documents, which hold exact copies."""
    docs = views.documents(spark, sf_dir).select("doc_id", "text")
    audits = [
        overlap_audit(prefix_split(docs, "doc_id", DOCUMENT_PREFIX, mode), "doc_id").select(
            F.lit(mode).alias("mode"), "*"
        )
        for mode in ("overlap", "disjoint")
    ]
    return audits[0].unionByName(audits[1])


def disjoint_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nest_turns(views.turns(spark, sf_dir))
    return sft.split_texts(nested, chatml_spaced(), EVAL_PREFIX, "disjoint")


def _written(df: DataFrame, label: str) -> str:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def nested_sharegpt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published shape: nested, other role names, no key."""
    path = _written(views.sharegpt_rows(spark, sf_dir), "sharegpt")
    rows = adapt(read_conversations(spark, path, schema=SHAREGPT), "sharegpt")
    return drop_null(render(from_rows(rows), chatml_spaced())).select("text")


def nested_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published shape: nested preferences without a key."""
    path = _written(views.preference_rows(spark, sf_dir), "preferences")
    pairs = preference.pairs_from_rows(read_preferences(spark, path))
    return pairs.select("pair_idx", "prompt", *P.SIDES)


def keyless_jsonl_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSONL as it is handed on, without keys, keyed and split exactly."""
    path = fresh_path(spark, "keyless")
    write_jsonl(P.chat_format(_pairs(spark, sf_dir)), path, drop=KEYS)
    rows = with_stored_key(read_pairs(spark, path, keyless(CHAT_PAIRS)))
    return split_exactly(rows, ["conv_id"]).groupBy("split").agg(F.count("*").alias("n"))


def dataset_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "dataset")
    write_splits(_split_texts(spark, sf_dir), root)
    return read_dataset(spark, root).select("conv_id", "split", "text")


def dpo_source_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclude_source(views.sources(spark, sf_dir), EXCLUDED_SOURCE)


def _kept_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclude_source(views.preference_turns(spark, sf_dir), EXCLUDED_SOURCE)


def _preferences(spark: SparkSession, sf_dir: str) -> Nested:
    return nest_preferences(_kept_turns(spark, sf_dir), probe=views.turns(spark, sf_dir))


def _pairs(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    return pairs_from_turns(
        views.preference_turns(spark, sf_dir), probe=views.turns(spark, sf_dir), **settings
    )


def _stored(df: DataFrame) -> DataFrame:
    """Narrow rows that several passes read, kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def pair_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.turn_validity(_kept_turns(spark, sf_dir))


def role_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles_only = _kept_turns(spark, sf_dir).withColumn("content", F.lit(None).cast("string"))
    return P.role_aligned(nest_preferences(roles_only, probe=views.turns(spark, sf_dir)))


def pair_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pair_candidates(_preferences(spark, sf_dir))


def dpo_single_turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


def pairs_batch_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, on_invalid="drop_batch", batch_size=BATCH)


def prompt_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = P.rendered_prompts(_pairs(spark, sf_dir), chatml_spaced())
    return done.select(*KEYS, "rendered", "recovered")


def pairs_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = P.chat_format(_pairs(spark, sf_dir))
    flat = [
        F.get(c, F.lit(0))[f].alias(f"{c}_{f}")
        for c in ("prompt", *P.SIDES)
        for f in ("role", "content")
    ]
    return chat.select(*KEYS, *flat)


def dpo_rendered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = P.chat_format(_pairs(spark, sf_dir))
    return P.render_pairs(chat, [chatml_compact(), instruct_tagged()])


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "pairs")
    write_jsonl(P.chat_format(_pairs(spark, sf_dir)), path)
    return P.plain_pairs(read_pairs(spark, path))


def preference_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "prepared")
    preference.prepare(_pairs(spark, sf_dir, first=PREFIX), path)
    return P.plain_pairs(read_pairs(spark, path))


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "training")
    preference.prepare(_pairs(spark, sf_dir), path)
    return training_input.training_rows(
        read_pairs(spark, path), chatml_compact(), budget=PAIR_BUDGET
    )


def pairs_skip_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, skip_leading_system=True)


def pairs_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with template markers come back from JSONL as they were recovered."""
    marked = views.preference_turns(spark, sf_dir, markers=True)
    path = fresh_path(spark, "recovered")
    preference.prepare(
        pairs_from_turns(marked, probe=views.turns(spark, sf_dir)), path, recover=True
    )
    return P.plain_pairs(read_pairs(spark, path))


def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _stored(_pairs(spark, sf_dir).select(*KEYS))
    return split_exactly(keys, KEYS)


def step_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _stored(exact_split(spark, sf_dir).filter(F.col("split") == "train"))
    return plan(train, KEYS, seed=35, batch_size=2, accumulation=4, max_steps=120)


def preference_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _stored(views.log_probs(_pairs(spark, sf_dir)))
    done = metrics(split_exactly(scored, KEYS), ["split"], beta=0.1)
    rounded = [F.round(c, 6).alias(c) for c in ("accuracy", "mean_margin", "mean_loss")]
    return done.select("split", "n", *rounded)


def stage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nest_preferences(
        views.preference_turns(spark, sf_dir), probe=views.turns(spark, sf_dir)
    )
    kept = ~F.col("source").eqNullSafe(F.lit(EXCLUDED_SOURCE))
    ok = kept & (F.col("status") == "ok")
    found = P.candidates_column()

    def sized(pairs: Column) -> Column:
        return F.sum(F.when(ok, F.size(pairs)))

    first = F.col("first_pos") == 0
    return stage_counts(
        P.with_status(nested),
        {
            "conversations": F.count_if(first),
            "source_kept": F.count_if(first & kept),
            "valid": F.count_if(first & ok),
            "candidates": sized(found),
            "pairs": sized(F.filter(found, P.survives)),
        },
    )


def balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", "lang")
    return sample(docs, "lang", ["doc_id"], PER_LANG)


def balanced_sample_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", "lang")
    return sample(docs, "lang", ["doc_id"], MANY_PER_LANG)


def length_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = sft.texts(views.turns(spark, sf_dir), chatml_spaced())
    return budget(texts, TOKEN_BUDGET).drop("text")


def completion_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(nest_turns(views.turns(spark, sf_dir)), chatml_spaced())


def prompt_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(
        views.questions(spark, sf_dir), "item_id", "text", views.SYSTEM_PROMPTS, chatml_spaced()
    )


def response_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = views.logged_generations(spark, sf_dir)
    output, prompt = F.col("output"), F.col("prompt")
    return logged.select(
        "conv_id",
        "turn",
        clean_response(output, prompt).alias("response"),
        clean_response(output, prompt, skip_special=False).alias("with_tokens"),
    )


def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text in its bin, with what must hold of a packing: texts lie one after another,
    within the budget, and the bins are few."""
    texts = sft.texts(views.turns(spark, sf_dir), chatml_spaced())
    sized = _stored(texts.select("conv_id", count_tokens(F.col("text")).alias("n_tokens")))
    packed = _stored(pack(sized, ["conv_id"], "n_tokens", PACK_BUDGET))
    used = F.least("n_tokens", F.lit(PACK_BUDGET))
    before = F.sum(used).over(W.partitionBy("bin").orderBy("start_pos")) - used
    histogram = sized.groupBy(used.alias("n")).agg(F.count("*").alias("rows")).collect()
    bound = least_bins([(r["n"], r["rows"]) for r in histogram], PACK_BUDGET)
    n_bins = packed.agg(F.countDistinct("bin")).scalar()
    return packed.select(
        "conv_id",
        "n_tokens",
        (F.col("start_pos") == before).alias("follows"),
        (F.col("start_pos") + used <= PACK_BUDGET).alias("fits"),
        (n_bins * 9 <= 11 * bound + 9).alias("few_bins"),
    )


def leak_free_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit and side of each document, where a family of two documents is a key; and the three
    counts that must be exact for all of them."""
    docs = views.documents(spark, sf_dir).select("doc_id", F.expr("doc_id div 2").alias("family"), "text")
    split = _stored(split_units_apart(docs, ["family"]))
    audit = overlap_audit(split, "family").select(F.struct("*").alias("audit")).scalar()
    united = split_units(split, ["family"], "text")
    return united.select("doc_id", "unit", audit.alias("audit")).select(
        "doc_id",
        "unit",
        F.col("audit")["n_eval"].alias("n_eval"),
        F.col("audit")["n_key_overlap"].alias("n_key_overlap"),
        F.col("audit")["n_text_overlap"].alias("n_text_overlap"),
    )


def parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read back from the rendered texts."""
    texts = sft.texts(views.turns(spark, sf_dir), chatml_spaced())
    parsed = texts.select("conv_id", parse_messages(F.col("text")).alias("parsed"))
    found = parsed.select("conv_id", "parsed.clear", F.posexplode("parsed.messages").alias("pos", "m"))
    return found.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content", "clear")


def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True token counts of each text by a public vocabulary, and what must hold of them and of the
    cut: the tokens hold every byte once, and the cut is the beginning of the text, within the budget.

    A cut that ends in white space may come out one token longer when it is encoded by itself.
    """
    texts = sft.texts(views.turns(spark, sf_dir), chatml_spaced())
    tokens = Tokens(spark, VOCABULARY)
    cut = cut_to_budget(texts, tokens, TRUE_BUDGET)
    sized = cut.withColumns(
        {"all": tokens.measured(F.col("text")), "kept": tokens.measured(F.col("cut_text"), TRUE_BUDGET)}
    )
    return sized.select(
        "conv_id",
        F.col("all")["n_bytes"].alias("n_bytes"),
        F.startswith("text", "cut_text").alias("begins"),
        (F.col("over_budget") == (F.col("cut_text") != F.col("text"))).alias("cut_if_over"),
        (F.col("kept")["n_tokens"] <= TRUE_BUDGET + 1).alias("fits"),
        F.col("n_tokens").between(F.regexp_count("text", F.lit(r"\S+")), F.col("all")["n_bytes"]).alias("plausible"),
    )


def streamed_nesting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of conversations that were nested from a stream of turns."""
    source, out, checkpoint = (fresh_path(spark, f"stream-{k}") for k in ("turns", "out", "checkpoint"))
    views.turns_in_time(spark, sf_dir).write.parquet(source)
    run_nesting(spark, source, out, checkpoint, "10 minutes", "1 hour").awaitTermination()
    nested = from_rows(spark.read.parquet(out).drop("first_pos"))
    return drop_null(render(nested, chatml_spaced())).select("conv_id", "text")


QUERIES: dict[str, Query] = {
    "role_normalize": role_normalize,
    "sft_chatml_text": _text(chatml_spaced),
    "sft_mistral_text": _text(instruct_folded),
    "dpo_qwen_text": _text(chatml_compact),
    "dpo_mistral_text": _text(instruct_tagged),
    "sft_null_filter": sft_null_filter,
    "generation_prompt": _text(chatml_spaced, generation=True),
    "sft_sharegpt_text": sft_sharegpt_text,
    "inst_prompt": inst_prompt,
    "take_prefix": take_prefix,
    "sft_eval_prefix": sft_eval_prefix,
    "tail_preview": tail_preview,
    "train_eval_overlap": train_eval_overlap,
    "dpo_source_exclude": dpo_source_exclude,
    "pair_validity": pair_validity,
    "role_aligned": role_aligned,
    "pair_candidates": pair_candidates,
    "dpo_single_turn_pairs": dpo_single_turn_pairs,
    "pairs_batch_abort": pairs_batch_abort,
    "prompt_recover": prompt_recover,
    "pairs_chat_format": pairs_chat_format,
    "dpo_rendered_pairs": dpo_rendered_pairs,
    "exact_split": exact_split,
    "stage_funnel": stage_funnel,
    "jsonl_roundtrip": jsonl_roundtrip,
    "preference_prepare": preference_prepare,
    "training_rows": training_rows,
    "dataset_roundtrip": dataset_roundtrip,
    "balanced_sample": balanced_sample,
    "step_plan": step_plan,
    "length_budget": length_budget,
    "completion_spans": completion_spans,
    "prompt_grid": prompt_grid,
    "response_clean": response_clean,
    "document_overlap": document_overlap,
    "disjoint_split": disjoint_split,
    "nested_sharegpt_text": nested_sharegpt_text,
    "nested_pairs": nested_pairs,
    "keyless_jsonl_split": keyless_jsonl_split,
    "pairs_skip_system": pairs_skip_system,
    "pairs_recovered": pairs_recovered,
    "balanced_sample_large": balanced_sample_large,
    "preference_metrics": preference_metrics,
    "pack_sequences": pack_sequences,
    "streamed_nesting": streamed_nesting,
    "parsed_messages": parsed_messages,
    "token_budget": token_budget,
    "leak_free_split": leak_free_split,
}
