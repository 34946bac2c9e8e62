"""Operator 3: chat formatting with Spark expressions only.

Template. Adjacent turns of one role form a block::

    ### role</role>text</turn>text</turn>\\n

Inside roles and texts ``\\`` is written ``\\\\``, ``#`` is written ``\\#``
and ``</`` is written ``<\\/``; no control string can then occur in them,
and ``unescape`` restores them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, ROLE_END, TURN_END, BLOCK_END = "### ", "</role>", "</turn>", "\n"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("#"), F.lit("\\#"))
    return F.replace(c, F.lit("</"), F.lit("<\\/"))


def unescape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\#"), F.lit("#"))
    c = F.replace(c, F.lit("<\\/"), F.lit("</"))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One formatted text per conversation, with its loss mask.

    Returns ``conv_id, n_turns, n_blocks, segments, formatted``:
    ``segments`` is an array of ``(text, loss)`` whose texts joined are
    ``formatted``; ``loss`` marks the (escaped) texts of ``loss_role``.

    Turns are escaped, collected as structs, sorted by (turn, role, text),
    and adjacent turns of one role share a block. A conversation is one
    output value, so its turns meet in one row by definition; nothing else
    is gathered. The sort and the merge are array expressions.

    Null text or role: empty. Null turn: before all others. Null
    conversation id: a conversation of its own. Equal turn numbers: by role
    and text; repeated rows are kept. No rows: none. Extra columns are
    ignored and may have any name.
    """
    rows = turns.select(F.col(conv_id).alias("conv_id"),
                        F.struct(F.col(turn).alias("turn"),
                                 escape(F.coalesce(F.col(role), F.lit(""))).alias("role"),
                                 escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
                                 (F.coalesce(F.col(role), F.lit("")) == loss_role).alias("loss")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def opens(i: Column) -> Column:
        return (i == 0) | (F.element_at("turns", F.greatest(i, F.lit(1)).cast("int"))["role"]
                           != F.element_at("turns", (i + 1).cast("int"))["role"])

    def pieces(t: Column, i: Column) -> Column:
        head = F.concat(F.when(i == 0, "").otherwise(BLOCK_END), F.lit(HEAD), t["role"], F.lit(ROLE_END))
        return F.array(F.struct(F.when(opens(i), head).otherwise("").alias("text"), F.lit(False).alias("loss")),
                       F.struct(t["text"].alias("text"), t["loss"].alias("loss")),
                       F.struct(F.lit(TURN_END).alias("text"), F.lit(False).alias("loss")))

    body = conv.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.concat(F.flatten(F.transform("turns", pieces)),
                                F.array(F.struct(F.lit(BLOCK_END).alias("text"), F.lit(False).alias("loss"))))
                       .alias("segments"))
    return body.select("conv_id", "n_turns",
                       F.size(F.filter("segments", lambda s: s["text"].endswith(ROLE_END))).cast("long").alias("n_blocks"),
                       "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """The array of ``(role, text)`` structs that a formatted text holds."""
    blocks = F.filter(F.split(formatted, HEAD), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        role = unescape(F.substring_index(block, ROLE_END, 1))
        parts = F.split(F.substring_index(block, ROLE_END, -1), TURN_END)
        return F.transform(F.slice(parts, 1, F.size(parts) - 1),
                           lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def read_loss(segments: Column) -> Column:
    """The array of unescaped texts under the loss mask."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"]))
