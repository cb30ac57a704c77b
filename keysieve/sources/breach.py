"""Breach corpus: text forms, and the one canonical table they become.

Text is either range files of ``SUFFIX:COUNT`` lines, whose five-hex prefix is
the file's name, or full-hash ``SHA1:COUNT`` lines (single-file form). The
canonical corpus is ``digest BINARY(20)`` (never null, one row per digest) and
``breach_count BIGINT``.

A downloaded corpus is ~1M small files named by prefix. Spark packs small files
into shared read tasks (``spark.sql.files.openCostInBytes``), so no per-file
task is created. The prefix comes from the file's own name without extensions
(``0A1B2``, ``0A1B2.txt``, ``0A1B2.txt.gz``) or from a ``prefix=0A1B2`` folder;
no other folder counts. A suffix line in a file without a prefix stops the
read (or is rejected with ``strict=False``): otherwise it would match nothing.

Malformed lines (no colon, a non-hex digest, a non-numeric count, a stray log
file) never raise: :func:`breach_rejects` counts them, and they are excluded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_PATTERN = r"^([0-9A-Fa-f]{35}|[0-9A-Fa-f]{40}):[0-9]+$"
FILE_PREFIX_PATTERN = r"(?:^|/)([0-9A-Fa-f]{5})(?:\.[^/]*)?$"
FOLDER_PREFIX_PATTERN = r"(?:^|/)prefix=([0-9A-Fa-f]{5})/"


def path_prefix(path: Column) -> Column:
    """Upper-case prefix of a corpus file, empty if it has none."""
    folder = F.regexp_extract(path, FOLDER_PREFIX_PATTERN, 1)
    return F.upper(F.when(folder != "", folder).otherwise(
        F.regexp_extract(path, FILE_PREFIX_PATTERN, 1)))


def parse_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """``lines(value, path)`` -> ``prefix, suffix, breach_count, ok``."""
    line = F.regexp_replace("value", r"\r$", "")
    digest = F.upper(F.split_part(line, F.lit(":"), F.lit(1)))
    full = F.length(digest) == 40
    formed = line.rlike(LINE_PATTERN)
    prefix = F.when(full, F.substring(digest, 1, 5)).otherwise(path_prefix(F.col("path")))
    if strict:
        prefix = F.when(formed & (prefix == ""), F.raise_error(
            F.concat(F.lit("no five-hex prefix in the name of "), "path"))).otherwise(prefix)
    count = F.split_part(line, F.lit(":"), F.lit(2)).try_cast("bigint")
    return lines.select(
        prefix.alias("prefix"),
        F.when(full, F.substring(digest, 6, 35)).otherwise(digest).alias("suffix"),
        count.alias("breach_count"),
        (formed & (prefix != "") & count.isNotNull()).alias("ok"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, path`` of every line of the file(s) under ``path``."""
    return (spark.read.option("recursiveFileLookup", "true").text(path)
            .select("value", F.col("_metadata.file_path").alias("path")))


def read_breach_ranges(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``prefix, suffix, breach_count`` for every well-formed line."""
    return parse_lines(read_lines(spark, path), strict).where("ok").drop("ok")


def count_rejects(lines: DataFrame) -> DataFrame:
    p = parse_lines(lines, strict=False)
    return p.agg(F.count(F.lit(1)).alias("lines"), F.count_if("ok").alias("accepted"),
                 F.count_if(~F.col("ok")).alias("rejected"))


def breach_rejects(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines read, lines accepted, lines rejected."""
    return count_rejects(read_lines(spark, path))


def corpus(lines: DataFrame) -> DataFrame:
    """Parsed lines -> canonical ``digest, breach_count``; of a digest that
    several lines have (overlapping downloads) the largest count stays."""
    digest = F.coalesce(F.unhex(F.concat("prefix", "suffix")), F.lit(bytearray()))
    return (lines.select(digest.alias("digest"), F.col("breach_count").cast("bigint"))
            .groupBy("digest").agg(F.max("breach_count").alias("breach_count")))


def with_range(corpus: DataFrame) -> DataFrame:
    """``prefix, suffix, breach_count`` of a canonical corpus."""
    h = F.hex("digest")
    return corpus.select(F.substring(h, 1, 5).alias("prefix"), F.substring(h, 6, 35).alias("suffix"),
                         "breach_count")


def write_breach_hashes(breach: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write full-hash ``SHA1:COUNT`` lines (the single-file form). Fires a job."""
    (breach.select(F.concat(F.hex("digest"), F.lit(":"), F.col("breach_count").cast("string")).alias("value"))
     .write.mode(mode).text(path))


def compact_breach(breach: DataFrame, name: str, path: str, buckets: int,
                   mode: str = "errorifexists") -> DataFrame:
    """One-off re-layout of a canonical corpus as table ``name`` at ``path``,
    bucketed and sorted by digest. Matching reads its buckets in place: the
    corpus is neither shuffled nor, with one file per bucket, moved. Choose
    ``buckets`` so that one holds about a gigabyte. The bucketing is known
    through the catalog only; reading the files by path loses it. Fires a job."""
    (breach.select("digest", "breach_count").repartition(buckets, "digest")
     .write.mode(mode).bucketBy(buckets, "digest").sortBy("digest")
     .option("path", path).saveAsTable(name))
    return breach.sparkSession.table(name)
