"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns as
context, and that reply, whose text alone is trainable.  A conversation that
does not end in a reply gets one more example without a trainable part, so no
turn is lost.  Turns are marked by the template; control strings inside texts
and roles are escaped reversibly, so that a formatted example can be read
back exactly (``read_turns``, ``loss_text``).

A conversation is one row while its examples are made; the examples stream
out of it one by one and are never held together (their texts grow with the
square of its turns, as the method says).  There is one shuffle, by
conversation.

Defined results: null texts and roles are empty; turns are ordered by number,
then role, then text (null numbers first), and repeated turns all count; rows
without a conversation id form one conversation; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col

START, END = "<|im_start|>", "<|im_end|>\n"


# -- template -------------------------------------------------------------

def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\`` and ``<|`` becomes ``<\|``: no control string
    is left, and every backslash begins a pair."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    """As ``escape``, and line ends too: a role is one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Reverses ``escape``."""
    parts = F.transform(F.split(text, r"\\\\"), lambda p: F.replace(p, F.lit("<\\|"), F.lit("<|")))
    return F.array_join(parts, "\\")


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("<\\|"), F.lit("<|")))
    return F.array_join(parts, "\\")


def segment(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"), escape(text), F.lit(END))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted example."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(F.substring(p, len(START) + 1, 1 << 30), "\n", 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.char_length(p))).alias("text")))


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """What the loss mask [start, end) covers, unescaped."""
    return unescape(F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int")))


# -- expansion ------------------------------------------------------------

def prefix_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text",
                    trained_role: str = "assistant") -> DataFrame:
    """One row per example: the conversation's id, ``n_turns`` of the example
    (its target is the last of them), ``is_last`` (it holds the whole
    conversation), ``formatted``, and the loss mask ``loss_start``,
    ``loss_end`` in code points (equal if nothing is trainable)."""
    read = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    rows = turns.select(col(conv_col).alias("conv"), F.struct(
        col(turn_col).alias("turn"), read(role_col).alias("role"), read(text_col).alias("text")).alias("t"))
    whole = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    targets = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda k: (
        F.get("turns", k - 1)["role"] == trained_role) | (k == F.size("turns")))
    each = whole.select("conv", F.transform("turns", lambda t: segment(t["role"], t["text"])).alias("segments"),
                        F.transform("turns", lambda t: t["role"] == trained_role).alias("trained"),
                        F.explode(targets).alias("k"))
    made = each.select("conv", "k", (F.col("k") == F.size("segments")).alias("is_last"),
                       F.get("trained", F.col("k") - 1).alias("trainable"),
                       F.array_join(F.slice("segments", F.lit(1), F.col("k")), "").alias("formatted"),
                       F.get("segments", F.col("k") - 1).alias("target"))
    total = F.char_length("formatted")
    # the reply's text lies between its first line and the end mark
    text_chars = F.char_length("target") - F.instr("target", "\n") - len(END)
    end = total - F.when(F.col("trainable"), F.lit(len(END))).otherwise(F.lit(0))
    return made.select(
        F.col("conv").alias(conv_col), F.col("k").cast("bigint").alias("n_turns"), "is_last", "formatted",
        (end - F.when(F.col("trainable"), text_chars).otherwise(0)).cast("bigint").alias("loss_start"),
        end.cast("bigint").alias("loss_end"))


def digest(examples: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its formatted examples: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``
    and ``n_examples``."""
    said = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.select(
        F.col(conv_col).alias("conv"), "n_turns", F.char_length("formatted").cast("bigint").alias("chars"),
        F.when(F.col("loss_end") > F.col("loss_start"), loss_text(
            F.col("formatted"), F.col("loss_start"), F.col("loss_end"))).alias("loss"),
        F.when(F.col("is_last"), F.struct(
            F.size(read_turns(F.col("formatted"))).cast("bigint").alias("n"),
            F.sha2(said, 256).alias("sha"))).alias("whole"))
    per = read.groupBy("conv").agg(
        F.max("whole").alias("whole"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"),
        F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("n_turns", "loss"))).alias("losses"))
    loss = F.array_join(F.transform(F.sort_array("losses"), lambda x: x["loss"]), "")
    return per.select(
        F.col("conv").alias(conv_col), F.col("whole.n").alias("n_turns"), F.col("whole.sha").alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")
