"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A turn is written as ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts a backslash breaks up every string that this
or another common template uses for control, and doubles itself, so that formatting can be undone exactly. Every
assistant turn is an example of its own: all turns before it are its context, and only its reply is trainable.

The turns of a conversation come in order of turn, role and text; null texts and roles count as empty, null turn numbers
come first, and rows with a null ``conv_id`` are one conversation. Repeated rows stay. Extra columns are ignored.

``formatted`` keeps a conversation's text once and its examples as spans of it; ``examples`` explodes them, each with its
whole context, and ``digests`` reads the loss back from these. What is trained on is therefore what is checked. Exploded
texts are not shuffled: of each only the part under its mask goes on, and rows stay dealt by conversation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What must not stay whole inside a text: the template's own marks and those of other common templates.
_CONTROL = r"\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"({_CONTROL})", "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, text, examples): one row for each conversation of *turns* (conv_id, turn, role, text).

    ``examples`` has, for every assistant turn in order, (turn, start, chars): its reply is ``chars`` code points of ``text``
    from ``start`` (counted from 1), and its context is all before ``start``.
    """
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "own")]
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.concat(F.lit(TURN), role, F.lit(TEXT)).alias("head"), text.alias("own"))
    whole = F.length("head") + F.length("own") + len(END)
    before = F.sum(whole).over(Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))
    rows = rows.select("conv_id", "turn", "role", "head", "own", F.coalesce(before, F.lit(0)).alias("before"), number.alias("number"))
    parts = F.array_sort(F.collect_list(F.struct("number", "turn", "role", "head", "own", "before")))
    return rows.groupBy("conv_id").agg(parts.alias("parts")).select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["own"], F.lit(END))), "").alias("text"),
        F.transform(F.filter("parts", lambda p: p["role"] == "assistant"), lambda p: F.struct(
            p["turn"].alias("turn"), (p["before"] + F.length(p["head"]) + 1).cast("int").alias("start"),
            F.length(p["own"]).alias("chars"))).alias("examples"))


def examples(conversations: DataFrame, carry: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """(conv_id, number, turn, text, loss_start, loss_chars): one row for each example of :func:`formatted`'s rows, written out.

    Columns *carry* come along. With *outer* a conversation without an example has one row of nulls.
    """
    expand = F.posexplode_outer if outer else F.posexplode
    return conversations.select("conv_id", *carry, "text", expand("examples").alias("number", "e")).select(
        "conv_id", *carry, "number", "e.turn",
        F.concat(F.substr("text", F.lit(1), F.col("e.start") + F.col("e.chars") - 1), F.lit(END)).alias("text"),
        F.col("e.start").alias("loss_start"), F.col("e.chars").alias("loss_chars"))


def read_turns(text: Column) -> Column:
    """(role, text) of every turn of a formatted conversation."""
    pieces = F.split(F.substr(text, F.lit(len(TURN) + 1)), r"<\|end\|>(?:<\|turn\|>|\z)", -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescaped(F.substring_index(p, TEXT, 1)).alias("role"),
        unescaped(F.substr(p, F.instr(p, TEXT) + len(TEXT))).alias("text")))


def digests(conversations: DataFrame) -> DataFrame:
    """What formatting and its reading back yield for every conversation, as digests; the loss comes from the examples."""
    read = conversations.withColumn("turns", read_turns(F.col("text")))
    read = read.select(
        "conv_id", "text", "examples", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256)
        .alias("turns_sha256"), F.length("text").cast("long").alias("formatted_chars"))
    whole = ["n_turns", "turns_sha256", "formatted_chars"]
    masked = examples(read, whole, outer=True).select(
        "conv_id", *whole, "number", unescaped(F.substr("text", "loss_start", "loss_chars")).alias("loss"))
    pieces = F.array_sort(F.collect_list(F.when(F.col("number").isNotNull(), F.struct("number", "loss"))))
    rows = masked.groupBy("conv_id", *whole).agg(pieces.alias("pieces")).withColumn("loss", F.array_join(F.col("pieces.loss"), ""))
    return rows.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
