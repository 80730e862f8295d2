"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all preceding turns are its context and only that
reply is trainable. Turns that no assistant turn follows are kept in one more example without a target,
so that no turn is lost.

A turn is written ``<s>[INST]role[/INST]text</s>``. A control string inside a role or text gets one
backslash after its first character (``</s>`` -> ``<\\/s>``); one that already has backslashes there gets
one more, so removing one backslash restores every text.

Defined cases: null text or role is empty; a null turn comes first; equal turns are ordered by role, then
text; repeated rows are repeated turns; a null conv_id is a conversation like any other; other columns are
ignored; an empty table gives no example. A conversation is brought together in one row, as its examples
and digests need it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed output format: the control strings of the template.
BOS, EOS, ROLE, END_ROLE = "<s>", "</s>", "[INST]", "[/INST]"
_ESCAPE = r"([<\[])(\\*)(/?s>|/?INST\])"
_UNESCAPE = r"([<\[])\\(\\*)(/?s>|/?INST\])"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPE, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _UNESCAPE, r"$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BOS + ROLE), escape(role), F.lit(END_ROLE), escape(text), F.lit(EOS))


def expand(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per example: conv_id, example (from 0), has_target,
    formatted, loss_start (code points before the trainable reply), loss_length."""
    empty = F.lit("")
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    whole = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_t"))
             .select("conv_id", "_t",
                     F.transform("_t", lambda t: render(t["role"], t["text"])).alias("_parts"),
                     F.transform("_t", lambda t: t["role"] == "assistant").alias("_reply")))
    size = F.size("_t")
    ends = F.filter(F.sequence(F.lit(1), size), lambda i: F.element_at("_reply", i.cast("int")) | (i == size))
    rows = whole.select("conv_id", "_t", "_parts", "_reply", F.posexplode(ends).alias("example", "_end"))
    target = F.element_at("_reply", F.col("_end"))
    last = F.element_at("_parts", F.col("_end"))
    body = F.length(escape(F.element_at("_t", F.col("_end"))["text"]))
    formatted = F.array_join(F.slice("_parts", F.lit(1), F.col("_end")), "")
    return (rows.select("conv_id", "example", target.alias("has_target"), formatted.alias("formatted"),
                        F.length(last).alias("_last"), body.alias("_body"))
            .select("conv_id", "example", "has_target", "formatted",
                    (F.length("formatted") - F.col("_body") - F.lit(len(EOS))).alias("loss_start"),
                    F.when(F.col("has_target"), F.col("_body")).otherwise(F.lit(0)).alias("loss_length")))


def read_turns(formatted: Column) -> Column:
    """Formatted string -> array of (role, text): the inverse of the template."""
    parts = F.split(formatted, EOS, -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    pattern = r"(?s)^<s>\[INST\](.*?)\[/INST\](.*)$"
    return F.transform(turns, lambda p: F.struct(
        unescape(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")))


def digests(examples: DataFrame) -> DataFrame:
    """Read the examples of :func:`expand` back: turns, trainable text and sizes per conversation."""
    loss = unescape(F.expr("substring(formatted, loss_start + 1, loss_length)"))
    per = examples.groupBy("conv_id").agg(
        F.max(F.struct("example", "formatted")).alias("_last"),
        F.sort_array(F.collect_list(F.when(F.col("has_target"), F.struct("example", loss.alias("loss"))))).alias("_loss"),
        F.sum(F.length("formatted")).alias("formatted_chars"))
    turns = F.transform(F.col("_turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (per.select("conv_id", "formatted_chars", read_turns(F.col("_last.formatted")).alias("_turns"),
                       F.array_join(F.col("_loss.loss"), "").alias("_text"))
            .select("conv_id", F.size("_turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                    F.length("_text").cast("long").alias("loss_chars"), F.sha2("_text", 256).alias("loss_sha256"),
                    F.col("formatted_chars").cast("long").alias("formatted_chars")))
