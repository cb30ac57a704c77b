"""Exact deduplication by content-defined chunk recipes.

A text is normalised (ASCII white space deleted) and cut at places that its own
characters decide, so copies are cut alike. Every chunk gets an identifier, and
a text becomes its recipe: the ordered list of its chunks' identifiers. Equal
texts have equal recipes; recipes, some bytes per kilobyte of text, are shuffled
to find the groups, not the texts.

Identifiers are verified: the distinct chunks are shuffled once (combined on the
map side, so a chunk that a third of the documents hold moves once per task) and
must never share an identifier. If two do, the next longer identifier is taken;
with 128 bits that is not expected for any corpus. Equal recipes therefore mean equal texts, not just equal hashes.

Defined results: a null text is empty, and all empty or white-space texts are
one group; a null id comes after every other id; rows that repeat an id and a
text are listed and counted each, and kept or dropped together; an empty table
gives an empty result; columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysieve.llm.common import texts
from keysieve.operators.lineage import materialize

WHITE = r"[\x20\x09-\x0D]+"
#: A chunk has MIN to MAX code points and ends after three characters like these, which should be
#: rare, so that cuts fall back into step after an edit. Texts without any such characters are cut
#: by length, which only lowers how many chunks near-copies share.
MIN_CHUNK, MAX_CHUNK, BOUNDARY = 512, 4096, "[d-f][m-p][e-k]"

Identifier = Callable[[Column], Column]
IDENTIFIERS: tuple[Identifier, ...] = (lambda c: F.unhex(F.md5(c.cast("binary"))), lambda c: F.sha2(c, 256))


def normalise(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, "")


def chunk_pattern(lo: int = MIN_CHUNK, hi: int = MAX_CHUNK, boundary: str = BOUNDARY) -> str:
    """Shortest run of ``lo`` to ``hi`` characters that ends at a boundary or at
    the end; else ``hi`` characters; a rest below ``lo`` is one chunk."""
    return rf"(?s).{{{lo},{hi}}}?(?:(?<={boundary})|\z)|.{{{lo},{hi}}}|.+"


def chunks(normalised: Column, pattern: str) -> Column:
    return F.regexp_extract_all(normalised, F.lit(pattern), F.lit(0))


def chunk_dictionary(t: DataFrame, pattern: str, identifier: Identifier) -> DataFrame:
    """``(chunk_id, chunk)``: each distinct chunk of the corpus once."""
    return (t.select(F.explode(chunks(normalise(F.col("text")), pattern)).alias("chunk"))
            .select(identifier(F.col("chunk")).alias("chunk_id"), "chunk").distinct())


def shared_identifiers(dictionary: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk."""
    return dictionary.groupBy("chunk_id").count().where("count > 1").select("chunk_id")


def verified_identifier(t: DataFrame, pattern: str,
                        identifiers: Sequence[Identifier] = IDENTIFIERS) -> Identifier:
    """The first of ``identifiers`` that tells all chunks of the corpus apart."""
    for identifier in identifiers:
        if shared_identifiers(chunk_dictionary(t, pattern, identifier)).isEmpty():
            return identifier
    raise ValueError("no identifier tells all chunks apart")


def recipes(t: DataFrame, pattern: str, identifier: Identifier) -> DataFrame:
    """``(doc_id, n_points, text_sha256, recipe)`` per row of ``(doc_id, text)``."""
    n = t.select("doc_id", F.length("text").alias("n_points"), normalise(F.col("text")).alias("norm"))
    return n.select("doc_id", "n_points", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                    F.transform(chunks(F.col("norm"), pattern), lambda c: identifier(c)).alias("recipe"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                pattern: str | None = None,
                identifiers: Sequence[Identifier] = IDENTIFIERS) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``. Of equal
    texts the one with the most code points stays, then the smallest id."""
    t, pattern = texts(docs, id_col, text_col), pattern or chunk_pattern()
    r = materialize(recipes(t, pattern, verified_identifier(t, pattern, identifiers)), "recipes")
    # ~id falls as id grows and never overflows; in a maximum, null comes last.
    best = F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("not_id")))
    groups = (r.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
              .select(F.col("recipe").alias("group_recipe"), "group_size",
                      F.bitwise_not(F.col("best.not_id")).alias("keep_id")))
    # Written, so that both sides of the join are plain shuffles, whose hot partitions Spark splits.
    groups = materialize(groups.where("group_size > 1"), "recipe-groups")
    j = r.join(groups, r["recipe"] == groups["group_recipe"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return j.select("doc_id", keep.alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
