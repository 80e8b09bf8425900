"""Chat formatting: cumulative snapshots collapsed to maximal conversations.

Logs often hold a conversation once for each turn it had at the time.  A
rolling hash of each turn prefix identifies the logged conversations that
prefix a longer one; what is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import cut, known_groups, salted

#: Marks of the rendered text: fixed values.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turns_of(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, turn, role, text``; other columns are left out."""
    return df.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                     F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """A row per turn: ``conv_id, pos`` (from 1) and ``h1, h2``, 128 bits over
    all turns up to it.

    Each turn is hashed with its position, and the hashes are combined by a
    running exclusive or, so a conversation is streamed through, not gathered.
    Turns are ordered by turn number, then role and text; only hashes are
    sorted, not texts.
    """
    digest = F.sha2(F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}), 256)
    rows = turns.select("conv_id", "turn", digest.alias("digest"))
    order = Window.partitionBy("conv_id").orderBy("turn", "digest")
    rows = rows.withColumn("pos", F.row_number().over(order))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mixed: list[Column] = [F.bit_xor(F.xxhash64(F.lit(k), "pos", "digest")).over(so_far) for k in (1, 2)]
    return rows.select("conv_id", "pos", mixed[0].alias("h1"), mixed[1].alias("h2"))


def collapse(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, kept, same_id`` (the
    smallest conv_id with the very same turns) and ``copies`` of it.

    A conversation is kept if no other one begins with all its turns and
    continues, and it has the smallest id of its copies.  Null roles and texts
    are values of their own.  Rows with a null conv_id are one conversation.
    Repeated rows are repeated turns.  An empty table gives an empty result.
    """
    turns = turns_of(df, conv_col, turn_col, role_col, text_col)
    hashes = cut(prefix_hashes(turns))
    last = hashes.groupBy("conv_id").agg(F.max(F.struct("pos", "h1", "h2")).alias("last"))
    whole = last.select("conv_id", F.col("last.pos").alias("n_turns"), F.col("last.h1").alias("h1"),
                        F.col("last.h2").alias("h2")).withColumn("_salt", salted("conv_id"))
    whole = cut(whole)
    # every proper prefix once: a first turn that many conversations share is one row
    proper = (hashes.withColumnRenamed("pos", "n_turns").groupBy("h1", "h2", "n_turns").agg(F.count(F.lit(1)).alias("begin")))
    key = ["h1", "h2", "n_turns"]
    finals = known_groups(whole, key, {"same_id": F.min("conv_id"), "copies": F.count(F.lit(1))},
                          {"same_id": F.min("same_id"), "copies": F.sum("copies")})
    # a logged conversation prefixes a longer one if more begin with its turns than end with them
    prefixed = (finals.groupBy(*key).agg(F.first("copies").alias("copies")).join(proper, key)
                .filter("begin > copies").select(*key))
    maximal = finals.join(prefixed, key, "left_anti").select(*key, "_salt", F.lit(True).alias("maximal"))
    out = whole.join(finals, [*key, "_salt"]).join(maximal, [*key, "_salt"], "left")
    first = F.col("conv_id").eqNullSafe(F.col("same_id"))
    return out.select("conv_id", "n_turns", (F.coalesce("maximal", F.lit(False)) & first).alias("kept"), "same_id", "copies")


def render(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row per kept conversation: ``conv_id, n_turns, copies, text``.

    Each turn is rendered as open mark, role, newline, text, close mark and
    newline; a null role or text is empty.  See ``collapse`` for what is kept.
    """
    turns = turns_of(df, conv_col, turn_col, role_col, text_col)
    kept = collapse(df, conv_col, turn_col, role_col, text_col).filter("kept").select(
        F.struct("conv_id").alias("_key"), "n_turns", "copies")
    part = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE + "\n"))
    digest = F.sha2(F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}), 256)
    rows = turns.select(F.struct("conv_id").alias("_key"), "turn", digest.alias("digest"), part.alias("part"))
    texts = (rows.join(kept, "_key").groupBy("_key", "n_turns", "copies")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "part"))).alias("parts")))
    return texts.select(F.col("_key.conv_id").alias("conv_id"), "n_turns", "copies",
                        F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("text"))
