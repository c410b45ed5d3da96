"""Chat formatting after the collapse of cumulative snapshots, in DataFrame functions only.

A log often holds one conversation many times, each time with more turns. Every
turn gets the hash of all turns up to it: the XOR of hashes of (position, role,
text), three of 64 bits over a SHA-256 digest. A conversation whose whole hash
is also the hash of an inner turn of another one is a prefix of it; an
anti-join drops it. Conversations with equal hashes are equal, and the smallest
identifier stays. What is left is maximal and gets rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HASHES = ("h1", "h2", "h3")


def _digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; NULL and empty differ, and no role can run into a text."""
    size = F.coalesce(F.length(role).cast("string"), F.lit("null"))
    mark = F.when(text.isNull(), "-").otherwise("+")
    return F.sha2(F.concat(size, F.lit(":"), F.coalesce(role, F.lit("")), mark, F.coalesce(text, F.lit(""))), 256)


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = F.col(role_col).cast("string"), F.col(text_col).cast("string")
    return conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), _digest(role, text).alias("digest"),
        role.alias("role"), text.alias("text"),
    )


def maximal_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per maximal conversation: its id, n_turns and n_copies (equal ones, itself included)."""
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col).select("conv", "turn", "digest").distinct()
    order = Window.partitionBy("conv").orderBy("turn", "digest")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefixes = turns.withColumn("n", F.row_number().over(order)).withColumn(
        "last", F.lead(F.lit(False), 1, True).over(order)
    )
    prefixes = prefixes.withColumns(
        {h: F.bit_xor(F.xxhash64(F.lit(k), F.col("n"), F.col("digest"))).over(upto) for k, h in enumerate(_HASHES)}
    )
    key = ["n", *_HASHES]
    whole = prefixes.where("last").groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    inner = prefixes.where("NOT last").select(*key).distinct()
    kept = whole.join(inner, key, "left_anti")
    return kept.select(F.col("conv").alias(conv_col), F.col("n").cast("long").alias("n_turns"), "n_copies")


def format_chats(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    start: str = "<|",
    end: str = "|>",
) -> DataFrame:
    """One row per maximal conversation: its id, n_turns, n_copies and chat.

    A turn renders as ``<|role|>``, line feed, text, line feed. A ``<|`` inside a
    text gets a space, so no text can pose as a turn. Turns are ordered by
    ``turn``, NULL first, then by digest. Repeated rows count once. A NULL role
    renders as ``unknown``, a NULL text as nothing; rows with a NULL id form one
    conversation. An empty table gives an empty result. Only the four named
    columns are read. A conversation is one cell of the result, so it has to fit
    into one.
    """
    kept = maximal_conversations(conversations, conv_col, turn_col, role_col, text_col)
    kept = kept.withColumnRenamed(conv_col, "_kept")
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    said = F.replace(F.coalesce("text", F.lit("")), F.lit(start), F.lit(start[:1] + " " + start[1:]))
    head = F.concat(F.lit(start), F.coalesce("role", F.lit("unknown")), F.lit(end + "\n"))
    turns = turns.select("conv", F.struct("turn", "digest", F.concat(head, said, F.lit("\n")).alias("said")).alias("s"))
    rows = turns.join(kept, turns["conv"].eqNullSafe(kept["_kept"]))
    chats = rows.groupBy("conv").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("n_copies").alias("n_copies"),
        F.array_join(F.sort_array(F.collect_set("s"))["said"], "").alias("chat"),
    )
    return chats.withColumnRenamed("conv", conv_col)
