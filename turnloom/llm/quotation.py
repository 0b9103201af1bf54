"""Chat formatting by quotation linking (DataFrame operations only).

Lines that begin with ">" are quoted; the number of marks is the quote level. What is left of
a message is its own text. Passages are runs of lines of one level. Each line, each paragraph
of a passage, each passage and each whole own text, of any length, is hashed in normal form
(lower case, single spaces also for line ends, none between letters of scripts that are
written without), so a quote that the client has wrapped anew is still known. The earliest
message of a conversation that has the same of its own is the original. A quoted line belongs
to the original of the longest of passage, paragraph and line that has one. A
message replies to the original of most of the characters that it quotes at its lowest
matched level (the later one of equals); without a matched quote it replies to the message
before it. The conversation is then put in reply order: every message after the one it replies to,
replies to one message by their turn, each with all that follows from it (depth first).

Limit. A quote that is wrapped anew and is neither a whole line, paragraph, passage nor own text
of its original (half a paragraph, say) is not found.

Skew. The index has one row per conversation and hash, so a line that everybody writes or
quotes joins with one row. "The message before" comes from global ranks over range
partitions, not from a window per conversation. Conversations in which every message replies
to the one before are in order as they are; for the others, reply order is the rank in the
tour around the reply tree, found by pointer doubling: rounds grow with the logarithm of the
longest conversation.

Defined results: null texts are null own texts and quote nothing; a message of quotes only
has an empty text; a null conv_id is a conversation of its own; repeated rows are messages of
their own; null turns come first; an empty table gives no rows; other columns stay (names
that begin with ``_q`` are used here and must not occur).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnloom.llm.common import stored, table
from turnloom.operators.rank import range_rank

MARKS = r"^(?:[ \t]*>)+"
# "On Monday A wrote:" and the like, directly before a quote.
ATTRIBUTION = r"^\s*(?:On|Am|Le|El)\b.*(?:wrote|schrieb|écrit|escribió)[^\n]*:\s*$"
MIN_CHARS = 1  # every line that is not empty
# A space between letters of scripts that are written without spaces.
UNSPACED = (
    r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
    r"\x{3000}-\x{303F}\x{FF00}-\x{FFEF}]"
)
JOINT = f" (?<={UNSPACED} )(?={UNSPACED})"


def normal(line: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), r"\s+", " ")), JOINT, "")


def parsed(messages: DataFrame) -> DataFrame:
    """``messages`` with ``_q_lines``: array of (level, line) of each message."""
    lines = F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")
    marks = F.transform(lines, lambda x: F.regexp_extract(x, MARKS, 0))
    return messages.withColumn("_q_raw", lines).withColumn("_q_marks", marks).withColumn(
        "_q_lines",
        F.zip_with(
            "_q_raw",
            "_q_marks",
            lambda x, m: F.struct(
                F.length(F.regexp_replace(m, "[^>]", "")).alias("level"),
                F.when(m == "", x).otherwise(F.ltrim(F.substr(x, F.length(m) + 1))).alias("line"),
            ),
        ),
    ).drop("_q_raw", "_q_marks")


def without_attributions(lines: Column) -> Column:
    """Lines of level 0, without attributions of the quote that follows."""
    return F.filter(
        lines,
        lambda x, i: (x["level"] == 0)
        & ~(x["line"].rlike(ATTRIBUTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)),
    )


def own_text(lines: Column) -> Column:
    own = without_attributions(lines)
    return F.trim(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), F.lit("\n \t"))


def units(ranked: DataFrame) -> DataFrame:
    """(_q_conv, _q_rank, level, hash, lines): every line, paragraph of several lines and passage
    of several paragraphs; also the whole own text of a message with quotes. ``lines`` has
    the place and the length of each line.

    Each step is a column of its own, since an expression used inside a lambda is evaluated
    anew for every element.
    """
    lines, starts, run, ends = F.col("_q_lines"), F.col("starts"), F.col("run"), F.col("ends")

    def numbered(of: Column) -> Column:
        return F.transform(
            of, lambda x, i: F.struct(x["level"].alias("level"), i.alias("at"), normal(x["line"]).alias("line"))
        )

    flat, own = F.col("flat"), F.col("own")
    runs = (
        ranked.filter(F.size("_q_lines") > 0)
        .select(
            "_q_conv",
            "_q_rank",
            numbered(lines).alias("flat"),
            F.when(F.exists(lines, lambda x: x["level"] > 0), numbered(without_attributions(lines))).alias("own"),
        )
        .withColumn(
            "starts",
            F.filter(
                F.sequence(F.lit(0), F.size(flat) - 1),
                lambda i: (i == 0) | (F.get(flat, i)["level"] != F.get(flat, i - 1)["level"]),
            ),
        )
        .withColumn(
            "runs",
            F.transform(
                starts, lambda s, k: F.slice(flat, s + 1, F.coalesce(F.get(starts, k + 1), F.size(flat)) - s)
            ),
        )
        .select(
            "_q_conv",
            "_q_rank",
            F.explode(F.when(F.size(own) > 0, F.concat("runs", F.array(own))).otherwise(F.col("runs"))).alias("run"),
        )
    )
    filled = F.col("filled")
    # Empty lines, and the places before the first and after the last line, end paragraphs.
    cut = (
        runs.withColumn("filled", F.filter(run, lambda x: F.length(x["line"]) >= MIN_CHARS))
        .filter(F.size(filled) > 0)
        .withColumn(
            "ends",
            F.filter(
                F.sequence(F.lit(-1), F.size(run)),
                lambda i: (i < 0) | (i >= F.size(run)) | (F.length(F.get(run, i)["line"]) < MIN_CHARS),
            ),
        )
        .withColumn(
            "paragraphs",
            F.filter(
                F.transform(
                    ends, lambda e, k: F.slice(run, e + 2, F.coalesce(F.get(ends, k + 1), e + 1) - e - 1)
                ),
                lambda x: F.size(x) > 0,
            ),
        )
    )
    whole = F.when(F.size("paragraphs") > 1, F.array(filled)).otherwise(F.slice(F.array(filled), 1, 0))
    parts = F.concat(
        F.transform(filled, lambda x: F.array(x)), F.filter("paragraphs", lambda x: F.size(x) > 1), whole
    )
    unit = F.col("unit")
    text = F.regexp_replace(F.array_join(F.transform(unit, lambda x: x["line"]), " "), JOINT, "")
    return cut.select("_q_conv", "_q_rank", F.explode(parts).alias("unit")).select(
        "_q_conv",
        "_q_rank",
        F.get(unit, F.lit(0))["level"].alias("level"),
        F.sha2(text, 256).alias("hash"),
        F.transform(unit, lambda x: F.struct(x["at"].alias("at"), F.length(x["line"]).alias("n"))).alias("lines"),
    )


def replies(ranked: DataFrame) -> DataFrame:
    """(_q_rank, _q_parent) of messages that quote an earlier one of their conversation."""
    parts = units(ranked)
    index = parts.filter("level = 0").groupBy("_q_conv", "hash").agg(F.min("_q_rank").alias("_q_parent"))
    found = parts.filter("level > 0").join(index, ["_q_conv", "hash"]).filter("_q_parent < _q_rank")
    # The longest part that has an original decides for its lines.
    lines = found.select(
        "_q_rank", "level", F.size("lines").alias("size"), "_q_parent", F.explode("lines").alias("x")
    )
    decided = lines.groupBy("_q_rank", "level", "x.at").agg(
        F.max(F.struct("size", "_q_parent"))["_q_parent"].alias("_q_parent"), F.max("x.n").alias("n")
    )
    weighed = decided.groupBy("_q_rank", "level", "_q_parent").agg(F.sum("n").alias("n"))
    best = F.max(F.struct(-F.col("level"), "n", "_q_parent"))
    return weighed.groupBy("_q_rank").agg(best["_q_parent"].alias("_q_parent"))


def tour_order(tree: DataFrame) -> DataFrame:
    """(_q_rank, _q_position, depth) of the nodes of ``tree`` (_q_rank, _q_parent, _q_start).

    The tour enters (2 rank) and leaves (2 rank + 1) every node. Sums over the rest of the
    tour, of entries and of entries less exits, give position and depth.
    """
    first = tree.filter("_q_parent is not null").groupBy(F.col("_q_parent").alias("_q_rank")).agg(
        F.min("_q_rank").alias("child")
    )
    among = range_rank(
        tree.filter("_q_parent is not null").select("_q_parent", "_q_rank"), ["_q_parent", "_q_rank"], "at"
    )
    after = among.select(
        F.col("_q_parent").alias("same"), F.col("_q_rank").alias("sibling"), (F.col("at") - 1).alias("at")
    )
    siblings = among.join(after, "at").filter("same = _q_parent").select("_q_rank", "sibling")
    joined = tree.join(first, "_q_rank", "left").join(siblings, "_q_rank", "left")
    enter, leave = F.col("_q_rank") * 2, F.col("_q_rank") * 2 + 1
    steps = F.array(
        F.struct(enter.alias("id"), F.coalesce(F.col("child") * 2, leave).alias("next"), F.lit(1).alias("step")),
        F.struct(
            leave.alias("id"),
            F.coalesce(F.col("sibling") * 2, F.col("_q_parent") * 2 + 1).alias("next"),
            F.lit(-1).alias("step"),
        ),
    )
    tour = stored(
        joined.select(F.explode(steps).alias("s")).select(
            "s.id",
            "s.next",
            F.when(F.col("s.step") > 0, 1).otherwise(0).cast("long").alias("entries"),
            F.col("s.step").cast("long").alias("height"),
        ),
        "tour",
    )
    while not tour.filter("next is not null").isEmpty():
        ahead = tour.select(
            F.col("id").alias("next"), F.col("next").alias("far"), F.col("entries").alias("e"), F.col("height").alias("h")
        )
        tour = stored(
            tour.join(ahead, "next", "left").select(
                "id",
                F.col("far").alias("next"),
                (F.col("entries") + F.coalesce("e", F.lit(0))).alias("entries"),
                (F.col("height") + F.coalesce("h", F.lit(0))).alias("height"),
            ),
            "tour",
        )
    entered = tour.filter("id % 2 = 0").select(
        (F.col("id") / 2).cast("long").alias("_q_rank"), "entries", (-F.col("height")).alias("depth")
    )
    sized = tree.groupBy("_q_start").agg(F.count("*").alias("size"))
    return (
        tree.select("_q_rank", "_q_start")
        .join(sized, "_q_start")
        .join(entered, "_q_rank")
        .select("_q_rank", (F.col("size") - F.col("entries")).alias("_q_position"), "depth")
    )


def link_quotes(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, text, more) in reply order: ``text`` without quotes,
    position, parent_turn, depth and n_quoted (lines) added (columns of these names are
    replaced)."""
    messages = messages.drop("position", "parent_turn", "depth", "n_quoted")
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    ranked = range_rank(
        parsed(messages).withColumn("_q_conv", key), ["_q_conv", "turn"], "_q_rank"
    )
    linked = stored(replies(ranked), "replies")
    # One row per conversation, combined on the map side.
    starts = ranked.groupBy("_q_conv").agg(F.min("_q_rank").alias("_q_start"))
    places = stored(
        ranked.select("_q_rank", "_q_conv", "turn")
        .join(starts, "_q_conv")
        .join(linked.withColumnRenamed("_q_parent", "_q_quoted"), "_q_rank", "left")
        .select(
            "_q_rank",
            "_q_start",
            "turn",
            F.coalesce(
                "_q_quoted", F.when(F.col("_q_rank") > F.col("_q_start"), F.col("_q_rank") - 1)
            ).alias("_q_parent"),
        ),
        "places",
    )
    branched = places.filter("_q_parent < _q_rank - 1").select("_q_start").distinct()
    tree = stored(places.join(branched, "_q_start", "left_semi"), "trees")
    plain = places.join(branched, "_q_start", "left_anti").select(
        "_q_rank", (F.col("_q_rank") - F.col("_q_start")).alias("_q_position")
    )
    order = plain.withColumn("depth", F.col("_q_position"))
    if not tree.isEmpty():
        order = order.unionByName(tour_order(tree))
    parents = places.select(F.col("_q_rank").alias("_q_parent"), F.col("turn").alias("parent_turn"))
    placed = (
        places.select("_q_rank", "_q_parent")
        .join(parents, "_q_parent", "left")
        .join(order, "_q_rank")
        .select("_q_rank", "parent_turn", "depth", F.col("_q_position").alias("position"))
    )
    quoted = F.size(F.filter("_q_lines", lambda x: x["level"] > 0)).cast("long")
    return (
        ranked.withColumn("text", own_text(F.col("_q_lines")))
        .withColumn("n_quoted", F.when(F.col("_q_lines").isNull(), 0).otherwise(quoted))
        .join(placed, "_q_rank")
        .select(*messages.columns, "position", "parent_turn", "depth", "n_quoted")
    )


def op6_quotation(spark, sf_dir):
    return link_quotes(table(spark, sf_dir, "conversations"))
