"""Back from rendered text to messages: the inverse of the two ChatML templates.

A text is cut where one message ends and the next begins, so marks inside a content are left in
it as long as they do not make up such a place. Whether a mark in a text stood there before rendering cannot
be seen from the text, hence ``clear``: false where any mark is left inside a role or content.

Column expressions only: a text is split once, without backtracking.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from turnloom.functions.templates import ASSISTANT_HEADER, IM_END, IM_START

# What stands after a role and after a content.
FRAMES = {
    "chatml_spaced": (" \n", f" \n{IM_END}\n"),
    "chatml_compact": ("\n", f"{IM_END}\n"),
}


def parse_messages(text: Column, template: str = "chatml_spaced") -> Column:
    """``messages`` (role and content) and ``clear`` of a rendered text.

    A header for generation at the end is left out. Null, and a text that is not made of whole
    messages, gives null messages and a ``clear`` of false (null for null); an empty text gives an empty
    list. Rendering the messages again gives the text.
    """
    if template not in FRAMES:
        raise KeyError(f"no inverse of {template!r}; have {sorted(FRAMES)}")
    after_role, after_content = FRAMES[template]
    asked = F.endswith(text, F.lit(after_content + ASSISTANT_HEADER)) | (text == ASSISTANT_HEADER)
    whole = F.when(asked, F.left(text, F.length(text) - len(ASSISTANT_HEADER))).otherwise(text)
    framed = F.startswith(whole, F.lit(IM_START)) & F.endswith(whole, F.lit(after_content))
    size = F.length(whole) - len(IM_START) - len(after_content)
    between = F.substring(whole, F.lit(len(IM_START) + 1), size)
    pieces = F.split(between, rf"\Q{after_content}{IM_START}\E", -1)

    def message(piece: Column) -> Column:
        at = F.instr(piece, F.lit(after_role))
        return F.struct(
            F.left(piece, at - 1).alias("role"),
            F.substring(piece, at + len(after_role), F.length(piece)).alias("content"),
        )

    headed = F.forall(pieces, lambda p: F.contains(p, F.lit(after_role)))
    messages = (
        F.when(whole == "", F.array().cast("array<struct<role:string,content:string>>"))
        .when(framed & (size >= len(after_role)) & headed, F.transform(pieces, message))
    )

    def marked(m: Column) -> Column:
        cells = (m["role"], m["content"])
        return F.contains(cells[0], F.lit("\n")) | F.exists(
            F.array(*cells), lambda x: F.contains(x, F.lit(IM_START)) | F.contains(x, F.lit(IM_END))
        )

    clear = F.when(text.isNotNull(), F.coalesce(~F.exists(messages, marked), F.lit(False)))
    return F.struct(messages.alias("messages"), clear.alias("clear"))
