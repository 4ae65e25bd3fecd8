"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it as context, and only its own
text trainable. Turns are marked by control strings; in texts and roles these are escaped, so that
the formatted text can be taken apart again. A conversation that ends in another
role, or has no assistant turn, gets one more row with nothing to train on, so that the rows
marked ``whole`` together hold all turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    """No ``<|`` is left: a backslash is doubled, then one is put into each ``<|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As :func:`escape`; a line feed, which ends the role, becomes a backslash and an n."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """Inverse of :func:`escape_role`: pairs of backslashes are set aside while ``\\n`` is read."""
    parts = F.split(role, r"\\\\")
    read = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("<\\|"), F.lit("<|")))
    return F.array_join(read, "\\")


def expand(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target: str = "assistant",
) -> DataFrame:
    """``(conv_id, example, text, loss_start, loss_end, whole)``; offsets in code points.

    The mask is ``[loss_start, loss_end)``, which is empty in a row without a target. Null texts
    and roles are empty; rows of an equal turn are ordered by role and text and all
    kept, a null turn comes first; a null id is a conversation. Turns are gathered for each
    conversation: its examples, which repeat its text, need more room than its turns.
    An empty table gives no rows; other columns are not looked at.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("said"),
    )
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    head = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
    marked = talks.select(
        "conv_id",
        F.transform("said", lambda t: t["role"] == target).alias("is_target"),
        F.transform("said", lambda t: F.concat(head(t), escape(t["text"]), F.lit(END))).alias("parts"),
        F.transform("said", lambda t: F.char_length(escape(t["text"]))).alias("sizes"),
    )
    last = F.size("parts")
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: F.element_at("is_target", i) | (i == last))
    cut = marked.select("conv_id", "is_target", "parts", "sizes", F.posexplode(ends).alias("example", "n"))
    formatted = cut.select(
        "conv_id",
        "example",
        F.array_join(F.slice("parts", 1, F.col("n")), "").alias("text"),
        F.element_at("is_target", F.col("n")).alias("trains"),
        F.element_at("sizes", F.col("n")).alias("size"),
        (F.col("n") == F.size("parts")).alias("whole"),
    )
    stop = F.char_length("text") - len(END)
    return formatted.select(
        "conv_id",
        "example",
        "text",
        F.when(F.col("trains"), stop - F.col("size")).otherwise(F.lit(0)).alias("loss_start"),
        F.when(F.col("trains"), stop).otherwise(F.lit(0)).alias("loss_end"),
        "whole",
    )


def turns_of(text: Column) -> Column:
    """The turns of a formatted text as an array of ``(role, text)``."""
    pieces = F.filter(F.split(text, F.lit(END.replace("|", "\\|"))), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.regexp_extract(p, r"\A<\|im_start\|>([^\n]*)\n", 1)).alias("role"),
            unescape(F.regexp_replace(p, r"\A<\|im_start\|>[^\n]*\n", "")).alias("text"),
        ),
    )


def digests(examples: DataFrame) -> DataFrame:
    """What formatted examples hold, for each conversation.

    Each row is digested where it is read; only digests and trained texts are shuffled.
    """
    turns = turns_of(F.col("text"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.expr("substring(text, loss_start + 1, loss_end - loss_start)")
    read = examples.select(
        "conv_id",
        "example",
        F.char_length("text").alias("size"),
        F.when(F.col("whole"), F.size(turns)).cast("bigint").alias("n_turns"),
        F.when(F.col("whole"), F.sha2(said, 256)).alias("turns_sha256"),
        unescape(trained).alias("trained"),
    )
    held = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.sort_array(F.collect_list(F.struct("example", "trained"))).alias("trained"),
        F.sum("size").cast("bigint").alias("formatted_chars"),
    )
    learned = F.array_join(F.transform("trained", lambda t: t["trained"]), "")
    return held.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )
