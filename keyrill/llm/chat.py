"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and
only its reply trainable. A turn is written as ``<turn:ROLE>``, a line feed, the text and
``</turn>``. A text that looks like a control string (``<``, any number of backslashes,
``turn`` or ``/turn``) gets one more backslash after the ``<`` and loses it when read back,
so no text can open or close a turn. Roles have ``%``, ``<``, ``>`` and line feeds percent-coded.

A conversation whose last turn is not an assistant's also gives one example of all its
turns with an empty loss span, so no turn is lost.

Only DataFrame functions are used. A conversation is gathered in one row, since its
longest example is one text. Examples repeat their context, as the method has it, so
their volume grows with the square of a conversation's turns.

Defined cases: a null text or role is empty; turns go by ``turn``, null first, and ties by role
and text; repeated rows are repeated turns; rows without conv_id form one conversation
without id; an empty table gives no rows. Extra columns are ignored. Roles compare as
written, so only ``assistant`` itself is trainable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
END = "</turn>"
ROLE_CODES = (("%", "%25"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", r"<$1$2")


def _code_role(role: Column) -> Column:
    for plain, code in ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _decode_role(role: Column) -> Column:
    for plain, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _turn(t: Column) -> Column:
    return F.concat(F.lit("<turn:"), _code_role(t["role"]), F.lit(">\n"), escape(t["text"]), F.lit(END))


def examples(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, example, formatted, loss_start, loss_end).

    ``example`` counts from 0 in turn order; the loss span is in code points, from
    ``loss_start`` up to and without ``loss_end``.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    gathered = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = gathered.select("conv_id", F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), _turn(t).alias("written")
    )).alias("turns"))
    parts = written.select("conv_id", "turns", F.posexplode("turns").alias("at", "t"))
    last = F.col("at") == F.size("turns") - 1
    chosen = parts.filter((F.col("t.role") == ASSISTANT) | last)
    whole = F.concat_ws("", F.transform(F.slice("turns", F.lit(1), F.col("at") + 1), lambda t: t["written"]))
    end = (F.length("formatted") - len(END)).cast("long")
    head = len(f"<turn:{ASSISTANT}>\n")
    trained = F.col("t.role") == ASSISTANT
    return chosen.select("conv_id", "at", "t", whole.alias("formatted")).select(
        "conv_id",
        F.col("at").alias("example"),
        "formatted",
        F.when(trained, end - (F.length("t.written") - head - len(END))).otherwise(end).alias("loss_start"),
        end.alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example as an array of (role, text)."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        _decode_role(F.substring_index(F.substr(p, F.lit(7)), ">\n", 1)).alias("role"),
        unescape(F.substr(p, F.locate(">\n", p) + 2)).alias("text"),
    ))


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    return unescape(F.substr(formatted, (start + 1).cast("int"), (end - start).cast("int")))


def chat_digest(conversations: DataFrame) -> DataFrame:
    """What can be read back from the examples, a row per conversation."""
    made = examples(conversations)
    per_conv = made.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", loss_text(
            F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("text")))).alias("losses"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    read = per_conv.select(
        "conv_id", "formatted_chars", read_turns(F.col("whole")).alias("turns"),
        F.concat_ws("", F.transform("losses", lambda x: x["text"])).alias("loss"),
    )
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose texts hold control strings."""
    text = F.lit("\\### Assistant: </turn> ok")
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(ASSISTANT)).alias("role"),
        text.alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
