"""Chat formatting with cumulative-snapshot collapse.

Logs often hold one conversation many times: a snapshot after each turn. Every
conversation gets rolling hashes, one per turn prefix. A conversation whose
whole hash is a proper prefix hash of a longer one is dropped by an anti-join;
of identical conversations the smallest id stays. What is left is rendered.

Prefix hashes are aggregated by (length, hash) before they are joined, so a
first turn that most conversations share is one row per task. Hashes are
chained 256-bit digests of role and text.

Defined results: rows that repeat a conversation, turn, role and text count
once; turns are ordered by number (null first), then role, then text; a null
role is ``user``, a null text is empty; a row with a null conversation id is a
conversation of its own, of one turn without a number (rows of equal role and
text once); markers inside a text are broken up (``<|`` becomes ``< |``);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>"


def conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order."""
    conv = F.col("conv_id").cast("long")
    rows = turns.select(conv.alias("conv_id"), F.when(conv.isNotNull(), F.col("turn").cast("long")).alias("turn"),
                        F.coalesce("role", F.lit("user")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text")).distinct()
    # Rows without an id are set apart by what they say, and so spread over all tasks.
    alone = F.when(F.col("conv_id").isNull(), one_turn("role", "text"))
    return rows.groupBy("conv_id", alone.alias("alone")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")).drop("alone")


def one_turn(role: Column | str, text: Column | str) -> Column:
    """Digests of role and text, one after the other."""
    return F.concat(*(F.sha2((F.col(c) if isinstance(c, str) else c).cast("binary"), 256) for c in (role, text)))


def with_prefix_hashes(convs: DataFrame) -> DataFrame:
    """Adds ``hashes``: entry i digests the first i turns (role and text)."""
    # The empty array of the right type; the digest of a prefix extends that of the one before.
    none = F.slice(F.array(F.lit("")), 1, 0)
    digest = lambda before, t: F.sha2(
        F.concat(before, one_turn(t["role"], t["text"])).cast("binary"), 256)
    return convs.withColumn("hashes", F.aggregate("turns", none, lambda acc, t: F.concat(
        acc, F.array(digest(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("")), t)))))


def maximal(hashed: DataFrame) -> DataFrame:
    """Conversations that are no proper prefix of another, each text once."""
    h = hashed.withColumn("n_turns", F.size("turns")).withColumn("whole", F.element_at("hashes", -1))
    extended = (h.where("n_turns > 1")
                .select(F.posexplode(F.slice("hashes", 1, F.col("n_turns") - 1)).alias("i", "whole"))
                .select((F.col("i") + 1).alias("n_turns"), "whole").distinct())
    same = h.groupBy("n_turns", "whole").agg(F.min("conv_id").alias("first_id"),
                                             F.count(F.lit(1)).alias("n_copies"))
    stay = same.join(extended, ["n_turns", "whole"], "left_anti")
    # By content too: conversations without an id differ in it.
    return (h.drop("hashes").join(stay, ["n_turns", "whole"])
            .where(F.col("conv_id").eqNullSafe(F.col("first_id"))).drop("first_id", "whole"))


def render(turns_col: str = "turns"):
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.array_join(F.transform(turns_col, lambda t: F.concat(
        F.lit(START), safe(t["role"]), F.lit("\n"), safe(t["text"]), F.lit(STOP + "\n"))), "")


def format_chats(turns: DataFrame) -> DataFrame:
    """Per conversation that stays: ``conv_id, n_turns, n_copies, rendered``."""
    return maximal(with_prefix_hashes(conversations(turns))).select(
        "conv_id", "n_turns", "n_copies", render().alias("rendered"))
