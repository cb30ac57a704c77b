"""Breach matching: SHA-1 digest of each candidate joined to a breach corpus.

Design for a corpus of ~10^9 digests and 10^7..10^9 candidates:

* candidates are distinct before hashing (hot passwords collapse map-side);
* the corpus is canonical: a 20-byte binary ``digest``, unique and never null,
  and a BIGINT count (:func:`keysieve.sources.breach.corpus`), so a match never
  multiplies candidates; half the bytes of two hex strings are shuffled, and a
  corpus bucketed by digest is not shuffled at all;
* how to join is left to Catalyst and AQE, which know the sizes at run time;
  SHA-1 is uniform, so the join key has no skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.functions import digest as dg
from keysieve.operators.lineage import materialize

JOIN_KEY = "_digest_key"
BYTES = "password_bytes"


def with_digest(df: DataFrame, col: str = "password", charset: str = "UTF-8") -> DataFrame:
    """Add ``sha1`` (40 upper-case hex), ``prefix`` (5) and ``suffix`` (35): of
    the original bytes if the frame carries them (``password_bytes``), else of
    the string in ``charset``."""
    sha1 = dg.sha1_of_bytes(BYTES) if BYTES in df.columns else dg.sha1_hex(col, charset)
    return (df.withColumn("sha1", sha1)
            .withColumns({"prefix": dg.range_prefix("sha1"),
                          "suffix": dg.range_suffix("sha1")}))


def _candidate_key(match_on: str) -> F.Column:
    """Binary join key, made non-nullable with a value that no digest equals:
    a nullable key would make Catalyst infer ``isnotnull(key)`` and push it
    below the aggregates, hashing every raw row instead of each distinct one."""
    k = F.unhex("sha1") if match_on == "range" else F.unhex("suffix")
    return F.coalesce(k, F.lit(bytearray(b"\x00")))


def match_breach(candidates: DataFrame, corpus: DataFrame, how: str = "inner",
                 match_on: str = "range", strategy: str = "auto",
                 count_col: str = "breach_count", charset: str = "UTF-8",
                 broadcast_max_rows: int | None = None) -> DataFrame:
    """Join candidates to ``corpus(digest, breach_count)`` (canonical).

    ``how``: ``inner`` (exposed only, with count), ``left`` (all candidates,
    NULL count -> 0 and an ``exposed`` flag), ``left_semi`` / ``left_anti``
    (candidate columns only). ``match_on="suffix"`` compares the last 35 hex
    digits, for corpora whose prefixes are lost (it cuts the digest, so a
    bucketed corpus is shuffled). ``strategy="auto"`` leaves the choice to
    Catalyst/AQE; ``"broadcast"`` counts the candidates and broadcasts
    them if they have at most ``broadcast_max_rows`` rows (which must be given);
    with more rows the join is planned as in ``auto``.
    """
    if match_on not in ("range", "suffix"):
        raise ValueError(f"match_on must be 'range' or 'suffix', not {match_on!r}")
    if "sha1" not in candidates.columns:
        candidates = with_digest(candidates, charset=charset)
    cand = candidates.withColumn(JOIN_KEY, _candidate_key(match_on))
    if match_on == "range":
        # A plain rename: the stored column stays the join key, bucketing included.
        right = corpus.select(F.col("digest").alias(JOIN_KEY), F.col(count_col))
    else:
        right = (corpus.select(F.unhex(F.substring(F.hex("digest"), 6, 35)).alias(JOIN_KEY), F.col(count_col))
                 .groupBy(JOIN_KEY).agg(F.max(count_col).alias(count_col)))

    if strategy == "broadcast":
        if broadcast_max_rows is None or how != "inner":
            raise ValueError("a broadcast of the candidates needs an inner join and broadcast_max_rows")
        # Counted by their staged keys: no plaintext is written.
        if materialize(cand.select(JOIN_KEY), "keys").count() <= broadcast_max_rows:
            cand = F.broadcast(cand)
    elif strategy != "auto":
        raise ValueError(f"unknown strategy {strategy!r}")

    if how in ("left_semi", "left_anti", "semi", "anti"):
        return cand.join(right, JOIN_KEY, how).drop(JOIN_KEY)
    if how not in ("inner", "left", "left_outer"):
        raise ValueError(f"unsupported join type {how!r}")
    out = cand.join(right, JOIN_KEY, how).drop(JOIN_KEY)
    if how != "inner":
        out = out.withColumns({
            "exposed": F.col(count_col).isNotNull().cast("int"),
            count_col: F.coalesce(F.col(count_col), F.lit(0).cast("bigint")),
        })
    return out


def exposure_by_class(labelled: DataFrame, breach: DataFrame,
                      label_col: str = "password_strength",
                      common_threshold: int = 10) -> DataFrame:
    """Per strength class: candidates, exposed candidates, summed breach count
    and candidates seen at least ``common_threshold`` times in breaches."""
    m = match_breach(labelled, breach, how="left")
    return (m.groupBy(label_col)
            .agg(F.count(F.lit(1)).alias("candidates"),
                 F.sum("exposed").cast("bigint").alias("exposed"),
                 F.sum("breach_count").cast("bigint").alias("breach_total"),
                 F.count_if(F.col("breach_count") >= common_threshold).alias("common")))
