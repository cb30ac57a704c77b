"""End-to-end breach audit of a word list, as one Spark job.

read word list -> drop blank lines -> one row per distinct string with its
frequency -> flags, score, label -> SHA-1 -> left join to the corpus ->
band -> Parquet. Nothing runs until the write; the written table cuts the
lineage for later stages (sampling, models).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysieve.functions import charclass as cc
from keysieve.operators import breach, features
from keysieve.sources import breach as breach_src
from keysieve.sources import io, wordlist

AUDIT_COLUMNS = ["password", "sha1", "freq", "is_lower", "is_upper", "is_digit",
                 "has_letter_and_digit", "has_digits", "has_upper", "has_lower", "has_symbols",
                 "has_spaces", "has_special_characters", "length", "score",
                 "password_strength", "breach_count", "exposed", "common_or_rare"]


def cleaned(candidates: DataFrame, max_length: int | None = None) -> DataFrame:
    """Non-blank candidates, one row per distinct string (and its bytes) with
    ``freq``; with ``max_length``, only strings shorter than that."""
    out = features.drop_blank(candidates)
    if max_length is not None:
        out = features.drop_long(out, max_length=max_length)
    keys = [c for c in ("password", breach.BYTES) if c in candidates.columns]
    return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("freq"))


def removed(candidates: DataFrame, max_length: int | None = None) -> DataFrame:
    """One row: ``lines``, and how many the audit leaves out as ``blank`` and
    as ``too_long``."""
    blank = F.col("password").isNull() | cc.is_blank("password")
    long = F.lit(False) if max_length is None else ~blank & (F.length("password") >= max_length)
    return candidates.agg(F.count(F.lit(1)).alias("lines"), F.count_if(blank).alias("blank"),
                          F.count_if(long).alias("too_long"))


def audit_frame(candidates: DataFrame, corpus: DataFrame, charset: str = "UTF-8",
                keep_plaintext: bool = True, max_length: int | None = None) -> DataFrame:
    """Lazy audit of a raw candidate column ``password`` (with repeats), and
    its ``password_bytes`` if there are any, against a canonical corpus.
    ``sha1`` tells apart byte strings that decode to one string."""
    lab = features.label(cleaned(candidates, max_length))
    exp = breach.match_breach(lab, corpus, how="left", charset=charset)
    out = features.with_frequency_band(exp).select(*AUDIT_COLUMNS)
    return out if keep_plaintext else out.drop("password")


def audit_wordlist(spark: SparkSession, wordlist_path: str, corpus_path: str, out_path: str,
                   charset: str = "ISO-8859-1", keep_plaintext: bool = False,
                   mode: str = "errorifexists", resume: bool = False,
                   max_length: int | None = None) -> DataFrame:
    """Run the audit from files and write it; returns the written table.

    ``charset`` is the word list's encoding, for features and display; the
    digest is taken over each line's own bytes. No password is left out for its
    length unless ``max_length`` is given (:func:`removed` counts those). With
    ``resume=True`` a finished output (``_SUCCESS`` present) is read instead
    of being recomputed, so a restarted job skips completed work."""
    def build() -> DataFrame:
        cands = wordlist.read_wordlist(spark, wordlist_path, charset=charset)
        corpus = breach_src.corpus(breach_src.read_breach_ranges(spark, corpus_path))
        return audit_frame(cands, corpus, charset, keep_plaintext, max_length)

    if resume:
        return io.stage(spark, out_path, build)
    io.write_parquet(build(), out_path, mode=mode)
    return io.read_parquet(spark, out_path)
