"""Chat formatting: every assistant turn becomes an example with all turns before it.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a control string and
the texts can be read back exactly; a newline in a role becomes ``<\\n``.  Only
DataFrame functions are used.

A conversation is one training text, so its turns meet in one row; its examples repeat
their context, which is what prefix expansion asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings and marks of the template (fixed values).
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example_no, formatted, loss_start, loss_length, is_last) of (conv_id, turn, role, text).

    One example per assistant turn: all turns up to it, with a loss on that reply alone, as
    code points of `formatted`.  Turns after the last assistant turn, or a conversation
    without one, give a closing example without loss (loss_length null), so that nothing is
    lost; `is_last` marks the example that holds the whole conversation.

    Turns are ordered by turn, then role and text; a null turn comes first, and repeated
    rows are turns of their own.  Null roles and texts count as empty, a null conv_id as one
    conversation.  No rows give no examples.  Other columns are not read.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("one"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
    parts = ordered.select(
        "conv_id",
        F.size("all").alias("n"),
        F.transform("all", lambda t: F.concat(F.lit(TURN_START), escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(TURN_END))).alias("written"),
        F.transform("all", lambda t, i: F.when(t["role"] == TRAINED_ROLE, F.struct((i + 1).alias("upto"), F.length(escaped(t["text"])).alias("loss_length")))).alias("replies"),
    )
    wanted = F.filter("replies", lambda r: r.isNotNull())
    closing = F.when(F.coalesce(F.element_at("replies", -1)["upto"], F.lit(0)) < F.col("n"), F.array(F.struct(F.col("n").alias("upto"), F.lit(None).cast("int").alias("loss_length"))))
    each = parts.select("conv_id", "n", "written", F.posexplode(F.concat(wanted, F.coalesce(closing, F.array().cast("array<struct<upto:int,loss_length:int>>")))).alias("example_no", "reply"))
    made = each.select("conv_id", "example_no", "n", "reply", F.array_join(F.slice("written", F.lit(1), F.col("reply.upto")), "").alias("formatted"))
    return made.select(
        "conv_id",
        "example_no",
        "formatted",
        (F.length("formatted") - len(TURN_END) - F.col("reply.loss_length")).alias("loss_start"),
        F.col("reply.loss_length").alias("loss_length"),
        (F.col("reply.upto") == F.col("n")).alias("is_last"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example as an array of (role, text)."""
    pieces = F.split(formatted, "<\\|im_end\\|>\n")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(TURN_START) + 1, 2147483647)
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(F.substr(body, F.length(role) + 2)).alias("text"))

    return F.transform(turns, turn)


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text an example is trained on, unescaped (null without loss)."""
    return unescaped(F.substr(formatted, start + 1, length))


def digests(made: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from its examples."""
    whole = F.when(F.col("is_last"), read_turns(F.col("formatted")))
    spoken = F.concat(F.lit(""), F.array_join(F.transform(whole, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""))
    each = made.select(
        "conv_id",
        F.size(whole).cast("long").alias("n"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.struct("example_no", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("reply")).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )
    replies = F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: F.coalesce(x["reply"], F.lit(""))), "")
    return each.groupBy("conv_id").agg(
        F.max("n").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        replies.alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
