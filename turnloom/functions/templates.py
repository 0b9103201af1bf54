"""Chat templates as column expressions over ``array<struct<role, content>>``.

A template renders the text of one conversation as ``prefix + body + suffix``. The body
is a concatenation over messages, so a conversation that was split into consecutive
rows is rendered row by row and joined afterwards (``operators.render``). Only the
folded instruct format looks back: a system message waits for the next user message.
What is waiting when a row begins is handed in as ``carry``.

A missing message list, or a missing role or content that the format would print, makes
the text null, and null texts are dropped by ``operators.select.drop_null``.
``array_join`` would skip null parts without a word, hence the explicit guards.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from turnloom.functions.folds import fold_list
from turnloom.functions.text import after_last, before_first, strip

# The marker texts of the formats.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
ASSISTANT_HEADER = "<|im_start|>assistant\n"
SPACED_USER_HEADER = "<|im_start|>user \n"
INST_OPEN = "[INST] "
INST_CLOSE = " [/INST]"
SYSTEM_OPEN = "[SYSTEM_PROMPT] "
SYSTEM_CLOSE = " [/SYSTEM_PROMPT]"
BOS = "<s>"
EOS = "</s>"

# Names one data source gives to the three roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "system": "system"}

PRINTED_BY_INSTRUCT = ("system", "user", "assistant")


def normal_role(role: Column) -> Column:
    """Rename known roles; any other role passes through."""
    pairs = [F.lit(x) for item in ROLE_NAMES.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), role), role)


@dataclass(frozen=True)
class Template:
    """How to render one conversation."""

    name: str
    body: Callable[[Column, Column | None], Column]
    prefix: str = ""
    generation_suffix: str = ""
    carry: Callable[[Column], Column] | None = None
    # Characters printed before a content, not counting the role, and after it; None
    # where that depends on more than the message.
    around_content: tuple[int, int] | None = None

    def text(self, messages: Column, generation: bool = False) -> Column:
        """The whole text of a conversation held in one message list."""
        return self.finish(self.body(messages, None), generation)

    def finish(self, body: Column, generation: bool = False) -> Column:
        """Add what comes before the first and after the last message."""
        ends = self.generation_suffix if generation else ""
        if not self.prefix and not ends:
            return body
        return F.concat(F.lit(self.prefix), body, F.lit(ends))


def _per_message(messages: Column, part: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(messages, part), "")


def _unless_missing(messages: Column, missing: Callable[[Column], Column], text: Column) -> Column:
    return F.when(messages.isNull() | F.exists(messages, missing), F.lit(None)).otherwise(text)


def _no_role_or_content(m: Column) -> Column:
    return m["role"].isNull() | m["content"].isNull()


def _no_printed_content(m: Column) -> Column:
    return m["content"].isNull() & m["role"].isin(*PRINTED_BY_INSTRUCT)


def _chatml(after_role: str, after_content: str) -> Callable[[Column, Column | None], Column]:
    def body(messages: Column, carry: Column | None = None) -> Column:
        text = _per_message(
            messages,
            lambda m: F.concat(
                F.lit(IM_START), m["role"], F.lit(after_role), m["content"], F.lit(after_content)
            ),
        )
        return _unless_missing(messages, _no_role_or_content, text)

    return body


def _tagged(eos: str) -> Callable[[Column, Column | None], Column]:
    def body(messages: Column, carry: Column | None = None) -> Column:
        text = _per_message(
            messages,
            lambda m: F.when(
                m["role"] == "system",
                F.concat(F.lit(SYSTEM_OPEN), m["content"], F.lit(SYSTEM_CLOSE)),
            )
            .when(m["role"] == "user", F.concat(F.lit(INST_OPEN), m["content"], F.lit(INST_CLOSE)))
            .when(m["role"] == "assistant", F.concat(F.lit(" "), m["content"], F.lit(eos)))
            .otherwise(F.lit("")),
        )
        return _unless_missing(messages, _no_printed_content, text)

    return body


def _folded(eos: str) -> Callable[[Column, Column | None], Column]:
    def body(messages: Column, carry: Column | None = None) -> Column:
        def part(waiting: Column, m: Column) -> Column:
            return (
                F.when(
                    m["role"] == "user",
                    F.concat(F.lit(INST_OPEN), waiting, m["content"], F.lit(INST_CLOSE)),
                )
                .when(m["role"] == "assistant", F.concat(m["content"], F.lit(eos)))
                .otherwise(F.lit(""))
            )

        waiting = F.lit("") if carry is None else F.coalesce(carry, F.lit(""))
        parts = fold_list(messages, waiting, part, _waiting_after, "string")
        joined = F.array_join(parts, "")
        return _unless_missing(messages, _no_printed_content, joined)

    return body


def _waiting_after(waiting: Column, m: Column) -> Column:
    """System content waits for a user message; a later system message replaces it."""
    return (
        F.when(m["role"] == "system", F.concat(m["content"], F.lit("\n")))
        .when(m["role"] == "user", F.lit(""))
        .otherwise(waiting)
    )


def _left_waiting(messages: Column) -> Column:
    """What a row leaves for the next one; null if it has no system or user message."""
    return F.aggregate(messages, F.lit(None).cast("string"), _waiting_after)


def _chatml_template(name: str, after_role: str, after_content: str) -> Template:
    return Template(
        name,
        _chatml(after_role, after_content),
        generation_suffix=ASSISTANT_HEADER,
        around_content=(len(IM_START + after_role), len(after_content)),
    )


def chatml_spaced() -> Template:
    """Header and content lines end in a space and a newline; any role is printed."""
    return _chatml_template("chatml_spaced", " \n", f" \n{IM_END}\n")


def chatml_compact() -> Template:
    """As ``chatml_spaced`` without the spaces and without a newline before the end mark."""
    return _chatml_template("chatml_compact", "\n", f"{IM_END}\n")


def instruct_folded(eos: str = EOS) -> Template:
    """System text goes into the next user block; other roles are dropped; no start mark."""
    return Template("instruct_folded", _folded(eos), carry=_left_waiting)


def instruct_tagged(bos: str = BOS, eos: str = EOS) -> Template:
    """System text in its own block; other roles are dropped; no generation suffix."""
    return Template("instruct_tagged", _tagged(eos), prefix=bos)


TEMPLATES: dict[str, Callable[..., Template]] = {
    "chatml_spaced": chatml_spaced,
    "chatml_compact": chatml_compact,
    "instruct_folded": instruct_folded,
    "instruct_tagged": instruct_tagged,
}


def template(name: str, **settings: str) -> Template:
    """Look up a template by name; ``settings`` are its ``bos`` / ``eos`` texts."""
    if name not in TEMPLATES:
        raise KeyError(f"unknown template {name!r}; have {sorted(TEMPLATES)}")
    return TEMPLATES[name](**settings)


def instruct_prompt(system: Column, user: Column) -> Column:
    """Prompt of one optional system text and one user text, ready for generation."""
    head = F.lit(BOS + INST_OPEN)
    return F.when(
        system.isNotNull(), F.concat(head, system, F.lit("\n"), user, F.lit(INST_CLOSE))
    ).otherwise(F.concat(head, user, F.lit(INST_CLOSE)))


def recover_prompt(rendered: Column, header: str = SPACED_USER_HEADER, end: str = IM_END) -> Column:
    """User text of a rendered prompt: after the last header, before the first end mark.

    A prompt rendered with another header keeps that header, and content that itself
    holds a mark is cut at it.
    """
    return strip(before_first(after_last(rendered, header), end))
