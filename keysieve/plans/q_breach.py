"""Queries: breach corpus parsing and the candidate/breach joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.config import scratch_path
from keysieve.operators import breach as B
from keysieve.operators import features
from keysieve.plans.oracle import sql
from keysieve.plans.registry import query
from keysieve.sources import breach as breach_src
from keysieve.sources import tables as T

#: Candidates (a short string, a digest and two parts of it) that may be broadcast.
BROADCAST_ROWS = 500_000
#: Digests counted as often are written as range files, a file for each, by so many tasks.
COMMON, WRITERS = 20, 16
#: Name of the bucketed corpus in the catalog; a later call takes its place.
COMPACT_TABLE = "keysieve_compact_corpus"
MATCH_COLS = ["password", "freq", "sha1", "prefix", "suffix", "breach_count"]


@query("exposure_by_class", sql("""
SELECT password_strength, count(*) AS candidates, sum(exposed)::BIGINT AS exposed,
       sum(breach_count)::BIGINT AS breach_total,
       count(*) FILTER (WHERE breach_count >= 10) AS common
FROM exposure GROUP BY password_strength"""))
def exposure_by_class(spark, d):
    """Flagship: candidates -> flags -> label -> SHA-1 -> breach join -> per class."""
    return B.exposure_by_class(T.labelled(spark, d), T.breach(spark, d))


@query("breach_match_inner", sql(f"SELECT {', '.join(MATCH_COLS)} FROM matched"))
def breach_match_inner(spark, d):
    return B.match_breach(T.candidates(spark, d), T.breach(spark, d)).select(*MATCH_COLS)


@query("breach_match_broadcast", sql(f"SELECT {', '.join(MATCH_COLS)} FROM matched"))
def breach_match_broadcast(spark, d):
    """Candidate side counted, and broadcast only if its row count allows."""
    return B.match_breach(T.candidates(spark, d), T.breach(spark, d), strategy="broadcast",
                          broadcast_max_rows=BROADCAST_ROWS).select(*MATCH_COLS)


@query("breach_match_suffix", sql("""
SELECT d.password, d.freq, d.sha1, d.prefix, d.suffix, b.breach_count
FROM digested d JOIN breach b ON d.suffix = b.suffix"""))
def breach_match_suffix(spark, d):
    """Compatibility mode: match on the 35-char suffix alone."""
    return B.match_breach(T.candidates(spark, d), T.breach(spark, d),
                          match_on="suffix").select(*MATCH_COLS)


@query("breach_exposure_left",
       sql("SELECT password, freq, breach_count, exposed FROM exposure"))
def breach_exposure_left(spark, d):
    return B.match_breach(T.candidates(spark, d), T.breach(spark, d), how="left").select(
        "password", "freq", "breach_count", "exposed")


@query("exposed_only_semi", sql("""
SELECT password, freq FROM digested d
WHERE EXISTS (SELECT 1 FROM breach b WHERE b.prefix = d.prefix AND b.suffix = d.suffix)"""))
def exposed_only_semi(spark, d):
    return B.match_breach(T.candidates(spark, d), T.breach(spark, d),
                          how="left_semi").select("password", "freq")


@query("unexposed_anti", sql("""
SELECT password, freq FROM digested d
WHERE NOT EXISTS (SELECT 1 FROM breach b WHERE b.prefix = d.prefix AND b.suffix = d.suffix)"""))
def unexposed_anti(spark, d):
    return B.match_breach(T.candidates(spark, d), T.breach(spark, d),
                          how="left_anti").select("password", "freq")


@query("frequency_band", sql("""
SELECT password, breach_count,
       CASE WHEN breach_count >= 10 THEN 'common' ELSE 'rare' END AS common_or_rare
FROM matched"""))
def frequency_band(spark, d):
    m = B.match_breach(T.candidates(spark, d), T.breach(spark, d))
    return features.with_frequency_band(m).select("password", "breach_count", "common_or_rare")


@query("breach_parse", sql("SELECT prefix, suffix, breach_count FROM breach"))
def breach_parse(spark, d):
    """Write the corpus as ``SHA1:COUNT`` text under the checkpoint dir, then
    parse it back."""
    path = scratch_path(spark, "breach-lines")
    breach_src.write_breach_hashes(T.breach(spark, d), path)
    return breach_src.read_breach_ranges(spark, path)


def _stray(spark, d):
    """Lines that are none of a corpus."""
    return T.table(spark, d, "benchmark").select(F.explode(F.array("text", F.concat("text", F.lit(":12")))).alias("value"))


def range_files(spark, d):
    """The corpus as files on disk, in a folder that looks like a prefix.
    Very common digests are ``SUFFIX:COUNT`` lines in a folder per prefix, plain ones
    with CRLF or gzipped ones; the others are ``SHA1:COUNT`` lines, with
    benchmark texts as stray lines between them."""
    r = T.breach_ranges(spark, d).withColumn("n", F.col("breach_count").cast("string"))
    ranged, path = r.where(F.col("breach_count") >= COMMON), f"{scratch_path(spark, 'ranges')}/20251"
    even = F.col("breach_count") % 2 == 0
    for part, end, codec in ((ranged.where(even), "\r", "none"), (ranged.where(~even), "", "gzip")):
        (part.select("prefix", F.concat("suffix", F.lit(":"), "n", F.lit(end)).alias("value")).repartition(WRITERS, "prefix")
         .write.mode("append").partitionBy("prefix").option("compression", codec).text(path))
    rare = r.where(F.col("breach_count") < COMMON).select(F.concat(F.lower(F.concat("prefix", "suffix")), F.lit(":"), "n").alias("value"))
    rare.unionByName(_stray(spark, d)).write.mode("append").option("compression", "gzip").text(f"{path}/whole")
    return path


@query("breach_ranges_parse", sql("SELECT prefix, suffix, breach_count FROM breach"))
def breach_ranges_parse(spark, d):
    """The written range files (see ``range_files``) read to the canonical corpus."""
    return breach_src.with_range(breach_src.corpus(breach_src.read_breach_ranges(spark, range_files(spark, d))))


@query("breach_duplicates_left", sql(
    "SELECT password, freq, breach_count, exposed FROM exposure"))
def breach_duplicates_left(spark, d):
    """Two overlapping downloads: every line twice, once with an older count.
    A left join still returns each candidate once."""
    now = T.breach_ranges(spark, d)
    old = now.withColumn("breach_count", F.col("breach_count") - 1)
    return B.match_breach(T.candidates(spark, d), breach_src.corpus(now.unionByName(old)),
                          how="left").select("password", "freq", "breach_count", "exposed")


@query("breach_compact_match", sql(f"SELECT {', '.join(MATCH_COLS)} FROM matched"))
def breach_compact_match(spark, d):
    """Re-lay the corpus as a table bucketed by digest (a one-off job), then
    match candidates against it; the corpus side is not shuffled."""
    path = scratch_path(spark, "breach-compact")
    spark.sql(f"DROP TABLE IF EXISTS {COMPACT_TABLE}")
    table = breach_src.compact_breach(T.breach(spark, d), COMPACT_TABLE, path, buckets=8)
    return B.match_breach(T.candidates(spark, d), table).select(*MATCH_COLS)


@query("breach_rejects", sql("""
SELECT lines, accepted, lines - accepted AS rejected
FROM (SELECT (SELECT count(*) FROM breach) AS accepted,
             (SELECT count(*) FROM breach) + (SELECT 2 * count(*) FROM benchmark) AS lines)"""))
def breach_rejects(spark, d):
    """Line accounting of the corpus parser over good and stray lines."""
    good = T.breach_ranges(spark, d).select(F.concat("prefix", "suffix", F.lit(":"), F.col("breach_count").cast("string")).alias("value"))
    return breach_src.count_rejects(good.unionByName(_stray(spark, d)).withColumn("path", F.lit("file:/corpus/all.txt")))


@query("breach_corpus", sql("SELECT prefix, suffix, breach_count FROM breach"))
def breach_corpus(spark, d):
    return T.breach_ranges(spark, d)


@query("candidates", sql("SELECT password, freq FROM candidates"))
def candidates(spark, d):
    return T.candidates(spark, d)

