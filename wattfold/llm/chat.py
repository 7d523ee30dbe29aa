"""Chat formatting with a round trip through its own grammar, with column functions only.

A formatted conversation is a row of turns::

    conversation = { turn }
    turn         = "<s>[INST]" role "[/INST]" text "</s>"

``role`` and ``text`` hold none of the four control strings. One that a source has, with any number
of backslashes after its first character, gets one more there; reading takes one away. All control
strings begin with their only ``<`` or ``[``, so content never makes one up together with a mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
LEARNED_ROLE = "assistant"

# A control string after its first character, with the backslashes that content may have there.
_REST = r"(\\*/?(?:s>|INST\]))"
_CONTROL = r"</?s>|\[/?INST\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])" + _REST, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\" + _REST, "$1$2")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """The turns that the grammar finds: ``array<struct<role, text>>``, null where it is broken."""
    ends = F.split(formatted, CLOSE)

    def turn(segment: Column) -> Column:
        halves = F.split(F.substring(segment, len(OPEN) + 1, 2147483647), r"\[/INST\]", 2)
        whole = segment.startswith(OPEN) & (F.size(halves) == 2)
        # Each half alone: a control string made up across the mark is none.
        clean = ~halves[0].rlike(_CONTROL) & ~halves[1].rlike(_CONTROL)
        return F.when(
            whole & clean, F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))
        )

    return F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), turn)


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv, formatted, mask``.

    Every turn is rendered as it is and read back; where that does not give the turn, its content is
    escaped. The whole conversation is then read back and must be equal to its source, or the query
    fails. ``mask`` has an entry per turn: where in its own rendering the text that a model learns
    lies (``begin``, ``length``, in code points), null for turns of other roles.

    Turns go by turn number, then role, then text; null numbers come first. A null role or text
    counts as empty, null is a conversation of its own, repeated turns are all kept. Other columns are
    not looked at. A conversation is one text, so its turns come together in one row.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in (role_col, text_col))
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")
    )
    rows = rows.withColumn("found", parse(render(F.col("role"), F.col("text"))))
    source = F.array(F.struct("role", "text"))
    rows = rows.withColumn("clash", ~F.coalesce(F.col("found") == source, F.lit(False)))
    for name in ("role", "text"):
        rows = rows.withColumn(f"{name}_out", F.when(F.col("clash"), escape(F.col(name))).otherwise(F.col(name)))
    begin = F.char_length("role_out") + F.lit(len(OPEN) + len(MIDDLE))
    learned = F.struct(begin.alias("begin"), F.char_length("text_out").alias("length"))
    entry = F.struct(
        "turn", "role", "text", render(F.col("role_out"), F.col("text_out")).alias("out"),
        F.when(F.col("role") == LEARNED_ROLE, learned).alias("mask"),
    )
    chats = rows.groupBy("conv").agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    chats = chats.withColumn("formatted", F.array_join(F.col("turns.out"), ""))
    chats = chats.withColumn("found", parse(F.col("formatted")))
    equal = F.col("found") == F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    broken = F.raise_error(F.lit("a formatted conversation does not read back as its source"))
    checked = F.when(equal, F.col("formatted")).otherwise(broken.cast("string"))
    return chats.select(F.col("conv").alias(conv_col), checked.alias("formatted"), F.col("turns.mask").alias("mask"))


def learned_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order and with nothing between."""

    def part(segment: Column, at: Column) -> Column:
        return F.when(at.isNotNull(), unescape(F.substr(segment, at["begin"] + 1, at["length"])))

    segments = F.split(formatted, CLOSE)
    # Each turn's rendering without its end, beside its mask; the piece after the last end is empty.
    return F.array_join(F.zip_with(F.slice(segments, F.lit(1), F.size(mask)), mask, part), "")
