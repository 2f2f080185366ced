"""Conversations as text with a loss mask, from a declarative template.

A template names the control strings, the loss flag of each role and the transitions of a
finite-state machine over roles. A conversation becomes an array of segments, each a piece of text
with its loss flag; joined, they are the formatted text. Texts and roles are escaped so that no
control string can occur in them, and the escape can be undone. Everything is built from Spark's
own functions.

Defined cases: a null text or role is empty; turns are ordered by turn, then role and text, a null
turn first; repeated rows are turns of their own; rows without conv_id form one conversation; a
conversation whose roles the machine refuses is formatted all the same and marked ``valid`` false;
an empty table gives no rows; other columns are ignored. All turns of one conversation end up in
one row, which is what the result asks for.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Control strings, loss flags and role order. Control strings start with "<" or "["."""

    begin: str = "<s>"
    end: str = "</s>"
    role_open: str = "<|"
    role_close: str = "|>"
    turn_end: str = "<|end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    # What each control character becomes inside a text. The first one is the
    # escape's own character; it is escaped first and restored last.
    escapes: tuple[tuple[str, str], ...] = (
        ("&", "&amp;"),
        ("<", "&lt;"),
        ("|", "&#124;"),
        ("[", "&#91;"),
    )
    start: str = "start"
    accepting: tuple[str, ...] = ("assistant", "user")
    # (state, role) -> state; anything else is refused.
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )

    def escaped(self, text: Column) -> Column:
        for plain, code in self.escapes:
            text = F.replace(text, F.lit(plain), F.lit(code))
        return text

    def unescaped(self, text: Column) -> Column:
        for plain, code in reversed(self.escapes):
            text = F.replace(text, F.lit(code), F.lit(plain))
        return text

    def valid(self, turns: Column) -> Column:
        """Whether the machine accepts the roles in order; null is the refusing state."""
        moves = chain.from_iterable(
            (F.lit(f"{state}\n{role}"), F.lit(to)) for (state, role), to in self.transitions.items()
        )
        table = F.create_map(*moves)
        last = F.aggregate(
            turns,
            F.lit(self.start),
            lambda state, turn: F.try_element_at(table, F.concat_ws("\n", state, turn["role"])),
        )
        return F.coalesce(last.isin(*self.accepting), F.lit(False))


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation: conv_id, valid, segments (text, loss) in order, formatted text."""
    texts = rows.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    whole = texts.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_turn(turn: Column) -> Column:
        head = F.concat(
            F.lit(template.role_open), template.escaped(turn["role"]), F.lit(template.role_close)
        )
        return F.array(
            segment(head, F.lit(False)),
            segment(template.escaped(turn["text"]), turn["role"].isin(*template.loss_roles)),
            segment(F.lit(template.turn_end), F.lit(False)),
        )

    segments = F.concat(
        F.array(segment(F.lit(template.begin), F.lit(False))),
        F.flatten(F.transform("turns", of_turn)),
        F.array(segment(F.lit(template.end), F.lit(False))),
    )
    return whole.select(
        "conv_id", template.valid(F.col("turns")).alias("valid"), segments.alias("segments")
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted text, in order."""
    inner = F.substring(
        formatted,
        F.lit(len(template.begin) + 1),
        F.char_length(formatted) - len(template.begin) - len(template.end),
    )
    pieces = F.split(inner, r"\Q" + template.turn_end + r"\E")
    # What follows the last end mark is empty.
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    close = F.lit(template.role_close)

    def turn(piece: Column) -> Column:
        at = F.locate(template.role_close, piece)
        role = F.substring(piece, F.lit(len(template.role_open) + 1), at - len(template.role_open) - 1)
        text = F.substring(piece, at + F.char_length(close), F.char_length(piece))
        return F.struct(
            template.unescaped(role).alias("role"), template.unescaped(text).alias("text")
        )

    return F.transform(pieces, turn)


def loss_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, as it was before escaping."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: template.unescaped(s["text"])), "")


def conversation_digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Counts and digests of formatted conversations, read back from segments and text."""
    turns = read_turns(F.col("formatted"), template)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        formatted.withColumn("turns", turns)
        .withColumn("loss", loss_text(F.col("segments"), template))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )
