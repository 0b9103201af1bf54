"""Quality rules: distance of a document's histograms from those of its language.

Two histograms are compared with the reference of the document's language by the
Jensen-Shannon distance (base 2, 0 to 1): characters by class (white space, upper-case
letters, digits, punctuation, symbols, other), and words by the language's ``COMMON`` most
frequent words (all others are one bin). References are sums over all documents of a
language; a null language is a language of its own. A distance counts only for documents
long enough to have a histogram (``MIN_CHARS``, ``MIN_WORDS``), and as far as it exceeds what
a sample of that length differs by chance, sqrt(bins / (8 n ln 2)).

DataFrame operations only. The references come from one aggregation that is combined on the
map side (each task sends a word of a language once), and each task keeps the first ``COMMON``
words of a language. They are one row per language; they are
broadcast if counting shows at most ``BROADCAST_LANGUAGES``, joined otherwise. Texts are read
once and never shuffled; all measures of a row come from the row alone.

Defined results: null and empty texts have counts of 0 and fail the base rules; repeated
rows are judged alike; an empty table gives no rows; other columns stay (names that begin
with ``_js`` are used here and must not occur).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnloom.llm.common import WORD, stored, table

COMMON = 32
MIN_CHARS = 200
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.155
MAX_WORD_DISTANCE = 0.12
CLASSES = 6
BROADCAST_LANGUAGES = 10_000
REPEAT_WINDOW = 8  # a power of two
SLOTS = 64
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")

SYMBOLS = r"[#*$%&|<>]"
SPACE = r"[\x20\x09-\x0D]"
SMALL = r"[\p{L}&&[^\p{Lu}]]++"
UPPER = r"\p{Lu}"
DIGIT = r"\p{Nd}"
PUNCTUATION = r"[.,;:!?'\"()-]"
OTHER_SYMBOL = r"[^\p{L}\p{Nd}\x20\x09-\x0D.,;:!?'\"()-]"
LETTERS = r"\p{L}+"
# Bin k of the word histogram is written as the k-th of these characters.
BINS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _n(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def with_repeated_words(docs: DataFrame) -> DataFrame:
    """Add n_repeat_words: words covered by a window of eight words that occurs at least
    twice in the text.

    Each word is hashed once; hashes of two, four and eight words follow from pairs of
    shorter ones. Window hashes are sorted with their positions, so equal ones are neighbours;
    this is only done for texts in which some hash occurs twice. Each step is a column of its own,
    since an expression used inside a lambda is evaluated anew for every element.
    """
    n = REPEAT_WINDOW
    words, hashes, pairs = F.col("_js_words"), F.col("_js_hashes"), F.col("_js_pairs")
    steps = [1 << k for k in range(n.bit_length() - 1)]  # 1, 2, 4
    docs = docs.withColumn("_js_run1", F.transform(words, lambda w: F.xxhash64(w)))
    for step in steps:
        run = F.col(f"_js_run{step}")
        doubled = F.transform(run, lambda h, i: F.xxhash64(h, F.get(run, i + step)))
        docs = docs.withColumn(f"_js_run{2 * step}", doubled).drop(f"_js_run{step}")
    windows = F.slice(F.col(f"_js_run{n}"), F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
    sorted_pairs = F.array_sort(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    again = F.transform(
        pairs,
        lambda p, k: F.when(
            (F.get(pairs, k - 1)["h"] == p["h"]) | (F.get(pairs, k + 1)["h"] == p["h"]), p["i"]
        ),
    )
    covered = F.aggregate(
        F.col("_js_places"),
        F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(n), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return (
        docs.withColumn("_js_hashes", windows)
        .drop(f"_js_run{n}")
        .withColumn(
            "_js_pairs",
            F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), sorted_pairs),
        )
        .withColumn("_js_places", F.array_sort(F.filter(again, lambda i: i.isNotNull())))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("_js_hashes", "_js_pairs", "_js_places")
    )


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    counted = (
        docs.withColumn("_js_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
        .withColumn("_js_lines", lines)
        .withColumn("n_words", F.size("_js_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_js_words", "")).cast("long"))
        .withColumn("n_symbols", _n(text, SYMBOLS))
        .withColumn(
            "n_dup_lines",
            (F.size("_js_lines") - F.size(F.array_distinct("_js_lines"))).cast("long"),
        )
    )
    return (
        with_repeated_words(counted)
        .drop("_js_words", "_js_lines")
        .withColumn(
            "base_failed",
            (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
        )
    )


def with_class_counts(docs: DataFrame) -> DataFrame:
    """Add _js_classes: white space, upper case, digits, punctuation, symbols, other.

    Most characters are small letters; they are cut out first, so that the other classes
    are counted in a short string.
    """
    text = F.coalesce("text", F.lit(""))
    kinds = (SPACE, UPPER, DIGIT, PUNCTUATION, OTHER_SYMBOL)
    names = [f"_js_class{k}" for k in range(len(kinds))]
    short = docs.withColumn("_js_cut", F.regexp_replace(text, SMALL, ""))
    counted = short.withColumns({c: _n(F.col("_js_cut"), p) for c, p in zip(names, kinds)})
    rest = F.length(text).cast("long")
    for c in names:
        rest = rest - F.col(c)
    return counted.withColumn("_js_classes", F.array(*names, rest)).drop(*names, "_js_cut")


def measured(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep``, the base measures, and what the histograms are made of.

    Written once, without the texts unless they are kept: references and distances are
    both computed from this table.
    """
    text = F.coalesce("text", F.lit(""))
    rows = with_class_counts(base_rules(docs)).select(
        *keep,
        *BASE,
        "_js_classes",
        F.coalesce("lang", F.lit("")).alias("_js_lang"),
        F.length(text).alias("_js_chars"),
        F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0)).alias("_js_letters"),
    ).withColumn("_js_total", F.size("_js_letters").cast("long"))
    return stored(rows, "measures", compression="zstd")


def language_references(rows: DataFrame) -> DataFrame:
    """One row per language of ``measured`` rows: class shares, common words and their shares
    (others last)."""
    classes = rows.groupBy("_js_lang").agg(
        F.sum("_js_total").alias("_js_all"),
        *[F.sum(F.col("_js_classes")[k]).alias(f"c{k}") for k in range(CLASSES)],
    )
    chars = sum((F.col(f"c{k}") for k in range(CLASSES)), F.lit(0))
    share = F.array(*[F.coalesce(F.col(f"c{k}") / chars, F.lit(0.0)) for k in range(CLASSES)])
    words = (
        rows.select("_js_lang", F.explode("_js_letters").alias("w"))
        .groupBy("_js_lang", "w")
        .agg(F.count("*").alias("n"))
    )
    # Spark keeps the first COMMON rows of a language before the shuffle.
    nth = F.row_number().over(W.partitionBy("_js_lang").orderBy(F.desc("n"), "w"))
    common = (
        words.withColumn("nth", nth)
        .filter(F.col("nth") <= COMMON)
        .groupBy("_js_lang")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "w", "n"))).alias("top"))
    )
    top = F.coalesce(F.col("top"), F.array().cast("array<struct<nth:int,w:string,n:bigint>>"))
    known = F.transform(top, lambda t: t["n"] / F.col("_js_all"))
    counted = F.aggregate(top, F.lit(0).cast("long"), lambda acc, t: acc + t["n"])
    other = (F.col("_js_all") - counted) / F.col("_js_all")
    return classes.join(common, "_js_lang", "left").select(
        "_js_lang",
        share.alias("_js_class"),
        F.transform(top, lambda t: t["w"]).alias("_js_common"),
        F.size(top).alias("_js_known"),
        *_slots(top),
        F.when(F.col("_js_all") > 0, F.concat(known, F.array(other)))
        .otherwise(F.array(F.lit(0.0)))
        .alias("_js_share"),
    )


def _slots(top: Column) -> tuple[Column, Column]:
    """The common words by hash: for each of SLOTS slots its words, and "-" and their signs."""

    def in_slot(slot: int) -> Column:
        return F.filter(top, lambda t: _slot(t["w"]) == slot)

    own = [in_slot(slot) for slot in range(SLOTS)]
    sign = [
        F.concat(
            F.lit("-"),
            F.array_join(F.transform(x, lambda t: F.substring(F.lit(BINS), t["nth"], F.lit(1))), ""),
        )
        for x in own
    ]
    words = F.array(*[F.transform(x, lambda t: t["w"]) for x in own])
    return words.alias("_js_slots"), F.array(*sign).alias("_js_marks")


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


def js_distance(counts: Column, total: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of a histogram of counts from shares."""

    def gain(p, q):
        return F.when(p > 0, p * F.log2(p * 2 / (p + q))).otherwise(0.0)

    terms = F.zip_with(
        F.transform(counts, lambda c: c / total), reference, lambda p, q: gain(p, q) + gain(q, p)
    )
    twice = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return F.sqrt(F.greatest(twice / 2, F.lit(0.0)))


def with_word_bins(docs: DataFrame) -> DataFrame:
    """Add _js_bins: counts of the language's common words, in their order, and of others.

    Each word becomes one character, BINS[k] for the k-th common word, so that the
    counts are lengths of strings. It is compared with the common words of its slot only.
    """
    signs, counts, known = F.col("_js_signs"), F.col("_js_counts"), F.col("_js_known")
    slots, marks = F.col("_js_slots"), F.col("_js_marks")
    none = F.array().cast("array<bigint>")

    def sign(w: Column, slot: Column) -> Column:
        place = F.array_position(F.get(slots, slot), w).cast("int")
        return F.substring(F.get(marks, slot), place + 1, F.lit(1))

    def count(k: Column) -> Column:
        rest = F.replace(signs, F.substring(F.lit(BINS), k, F.lit(1)))
        return (F.length(signs) - F.length(rest)).cast("long")

    places = F.sequence(F.lit(1), F.greatest(known, F.lit(1)))
    others = F.col("_js_total") - F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return (
        docs.withColumn(
            "_js_signs", F.array_join(F.transform("_js_letters", lambda w: sign(w, _slot(w))), "")
        )
        .withColumn("_js_counts", F.when(known > 0, F.transform(places, count)).otherwise(none))
        .withColumn("_js_bins", F.concat(counts, F.array(others)))
        .drop("_js_signs", "_js_counts")
    )


def _within(distance: str, bins: int, n: Column, limit: float) -> Column:
    chance = F.sqrt(F.lit(bins / (8 * math.log(2))) / F.greatest(n, F.lit(1)))
    return F.coalesce(F.col(distance) - chance <= limit, F.lit(True))


def judge(docs: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all), the base measures, both distances (null
    below the guards) and ``kept``. Columns of those names are replaced."""
    added = [*BASE, "class_distance", "word_distance", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = measured(docs, keep)
    references = stored(language_references(rows), "languages")
    few = references.count() <= BROADCAST_LANGUAGES
    refs = F.broadcast(references) if few else references
    chars = F.col("_js_chars")
    judged = (
        with_word_bins(rows.join(refs, "_js_lang", "left"))
        .withColumn(
            "class_distance",
            F.when(
                chars >= MIN_CHARS, js_distance(F.col("_js_classes"), chars, F.col("_js_class"))
            ),
        )
        .withColumn(
            "word_distance",
            F.when(
                F.col("_js_total") >= MIN_WORDS,
                js_distance(F.col("_js_bins"), F.col("_js_total"), F.col("_js_share")),
            ),
        )
    )
    near = _within("class_distance", CLASSES, chars, MAX_CLASS_DISTANCE) & _within(
        "word_distance", COMMON + 1, F.col("_js_total"), MAX_WORD_DISTANCE
    )
    return judged.withColumn("kept", ~F.col("base_failed") & near).select(*keep, *added)


def op2_divergence(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents"), ["doc_id"])
