"""A breach corpus on disk that is read in part and renewed in part.

Layout under one root::

    data/range=0A/part-….parquet    rows sorted by digest, one folder per leading byte
    files/version=3/part-….parquet  the source files that the data was made of

Reading in part: folders are partitions, row groups are small and hold a short
interval of digests, and each has a Bloom filter on ``digest``. A list of a few
hundred digests is pushed into the scan as equalities: folders, row groups by
their interval, and row groups by their filter are left out before any page is
read. A list of more keys than there are row groups touches all of them and
is joined instead, folder by folder (:func:`lookup` counts the keys).

Renewing in part: a range file lists all digests of its five-digit prefix, so a
file that is new or has changed replaces the rows of its prefix, and a file that
is gone takes them away. Changed files are found by path, size and time against
the last manifest; only they are read, and only the folders they fall in are
written again (dynamic partition overwrite), from a staged table, since a
folder can't be read and replaced in one job. The manifest comes last: a run
that dies before is repeated with the same result. One writer at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keysieve.operators.lineage import materialize
from keysieve.sources import breach as breach_src
from keysieve.sources.io import has_success_marker

RANGE = "range"
#: Bytes of a row group: what one digest costs to read.
ROW_GROUP = 8 << 20
#: Bytes of a digest and its count in a file, about.
ROW_BYTES = 24
#: Rows of one file; a folder with more has several, each a part of the order.
ROWS_PER_FILE = 20_000_000
#: Keys that are pushed into a scan as equalities.
MAX_KEYS = 500
BLOOM_FPP = 0.01

FILE_COLUMNS = ["file", "bytes", "modified"]


def range_of(digest: str | Column) -> Column:
    """Folder of a digest: its first byte in hex."""
    d = F.col(digest) if isinstance(digest, str) else digest
    return F.substring(F.hex(d), 1, 2)


def _data(root: str) -> str:
    return f"{root.rstrip('/')}/data"


def _versions(root: str) -> str:
    return f"{root.rstrip('/')}/files"


def _filesystem(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write(rows: DataFrame, root: str, n: int, row_group: int, mode: str) -> None:
    """``rows(digest, breach_count)``, ``n`` of them, into their folders. The
    order of folder and digest is dealt in ranges, so a file is an interval."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_FILE))
    per_group = max(1, min(n, row_group // ROW_BYTES))
    (rows.select("digest", "breach_count", range_of("digest").alias(RANGE))
     .repartitionByRange(tasks, RANGE, "digest").sortWithinPartitions(RANGE, "digest")
     .write.mode(mode).partitionBy(RANGE)
     .option("partitionOverwriteMode", "dynamic")
     .option("parquet.block.size", row_group)
     .option("parquet.bloom.filter.enabled#digest", "true")
     .option("parquet.bloom.filter.expected.ndv#digest", per_group)
     .option("parquet.bloom.filter.fpp#digest", BLOOM_FPP)
     # Digests don't repeat: a dictionary would only be built and thrown away.
     .option("parquet.enable.dictionary#digest", "false")
     .parquet(_data(root)))


def write_store(corpus: DataFrame, root: str, row_group: int = ROW_GROUP) -> DataFrame:
    """A new store of the canonical ``corpus(digest, breach_count)``, without a
    manifest, and a scan of it. ``corpus`` is staged, as it is counted first."""
    rows = materialize(corpus.select("digest", "breach_count"), "corpus")
    _write(rows, root, rows.count(), row_group, "errorifexists")
    return read_store(corpus.sparkSession, root)


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """``digest, breach_count, range``; the folder's name is the range."""
    return (spark.read.schema(f"digest binary, breach_count bigint, {RANGE} string")
            .parquet(_data(root)))


def equalities(column: str, values: list[bytes]) -> Column:
    """``column`` equals one of ``values``, as a balanced tree of equalities:
    each reaches the scan's statistics and Bloom filters, which a list of over
    ten values in ``IN`` does not."""
    terms = [F.col(column) == F.lit(bytearray(v)) for v in values]
    while len(terms) > 1:
        terms = [reduce(Column.__or__, terms[i:i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


def prune(store: DataFrame, keys: DataFrame, max_keys: int = MAX_KEYS, key: str = "digest") -> DataFrame:
    """The part of ``store`` to read for ``keys``: ``digest, breach_count`` of at
    least every row whose digest is among them. Null keys match nothing.

    Up to ``max_keys`` distinct keys are taken to the driver (20 bytes each) and
    pushed into the scan. More keys than the store has row groups touch them
    all, so beyond that only folders without a key are left out. Fires a job."""
    distinct = materialize(keys.select(F.col(key).alias("digest")).where("digest is not null").distinct(), "keys")
    few = distinct.limit(max_keys + 1).collect()
    if len(few) > max_keys:
        folders = [r[0] for r in distinct.select(range_of("digest")).distinct().collect()]  # 256 at most
        return store.where(F.col(RANGE).isin(folders)).select("digest", "breach_count")
    values = sorted(bytes(r["digest"]) for r in few if r["digest"])
    if not values:
        return store.where(F.lit(False)).select("digest", "breach_count")
    folders = sorted({f"{v[0]:02X}" for v in values})
    return store.where(F.col(RANGE).isin(folders) & equalities("digest", values)).select("digest", "breach_count")


# Renewal from range files.

def list_files(spark: SparkSession, source: str) -> DataFrame:
    """``file, bytes, modified, prefix`` of every range file under ``source``,
    without reading any. Files without a prefix in their name are left out."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                     F.col("_metadata.file_modification_time").alias("modified")))
    return files.withColumn("prefix", breach_src.path_prefix(F.col("file"))).where("prefix <> ''")


def manifest_version(spark: SparkSession, root: str) -> int:
    """Number of the last finished manifest, 0 if there is none."""
    fs, p = _filesystem(spark, _versions(root))
    if not fs.exists(p):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    numbers = sorted((int(n.split("=")[1]) for n in names if n.startswith("version=")), reverse=True)
    return next((n for n in numbers if has_success_marker(spark, f"{_versions(root)}/version={n}")), 0)


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``file, bytes, modified, prefix`` that the store was made of."""
    version = manifest_version(spark, root) if version is None else version
    if not version:
        return spark.createDataFrame([], "file string, bytes bigint, modified timestamp, prefix string")
    return spark.read.parquet(f"{_versions(root)}/version={version}")


def changed_prefixes(now: DataFrame, before: DataFrame) -> DataFrame:
    """Distinct prefixes of files that are new, changed or gone."""
    new = now.join(before, FILE_COLUMNS, "left_anti").select("prefix")
    gone = before.join(now, FILE_COLUMNS, "left_anti").select("prefix")
    return new.union(gone).distinct()


def refresh(spark: SparkSession, root: str, listed: DataFrame, prefixes: DataFrame,
            row_group: int = ROW_GROUP) -> list[str]:
    """Replaces all rows of ``prefixes(prefix)`` by ``listed(prefix, suffix,
    breach_count)``; lines of other prefixes are ignored. Returns the folders
    written. Only folders of these prefixes are read and written."""
    prefixes = materialize(prefixes.select(F.upper("prefix").alias("prefix")).distinct(), "prefixes")
    # At most 256 names.
    folders = sorted(r[0] for r in prefixes.select(F.substring("prefix", 1, 2)).distinct().collect())
    if not folders:
        return []
    new = breach_src.corpus(listed.join(prefixes, "prefix", "left_semi"))
    fs, data = _filesystem(spark, _data(root))
    if fs.exists(data):
        old = read_store(spark, root).where(F.col(RANGE).isin(folders))
        old = old.withColumn("prefix", F.substring(F.hex("digest"), 1, 5))
        new = new.unionByName(old.join(prefixes, "prefix", "left_anti").select("digest", "breach_count"))
    merged = materialize(new, "merged")
    filled = {r[0]: r[1] for r in merged.groupBy(range_of("digest").alias(RANGE)).count().collect()}
    if filled:
        _write(merged, root, sum(filled.values()), row_group, "overwrite")
    for name in set(folders) - set(filled):  # no row is left, so no file replaces the folder
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_data(root)}/{RANGE}={name}"), True)
    return folders


def sync(spark: SparkSession, root: str, source: str, strict: bool = True, row_group: int = ROW_GROUP) -> list[str]:
    """Brings the store at ``root`` (made if it isn't there) to the state of the
    range files under ``source``, reading the changed ones alone, and returns
    the folders written."""
    version = manifest_version(spark, root)
    now = materialize(list_files(spark, source), "files")
    before = read_manifest(spark, root, version)
    prefixes = materialize(changed_prefixes(now, before), "changed")
    changed = now.join(prefixes, "prefix", "left_semi")
    # Older files are left out when the folder is listed; the rest by the names of the changed ones.
    since = changed.agg(F.date_format(F.min("modified") - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    written: list[str] = []
    if not prefixes.isEmpty():
        lines = _lines(spark, source, since).join(changed.select(F.col("file").alias("path")), "path", "left_semi") \
            if since else spark.createDataFrame([], "path string, value string")
        listed = breach_src.parse_lines(lines, strict).where("ok").drop("ok")
        written = refresh(spark, root, listed, prefixes, row_group)
        now.write.mode("overwrite").parquet(f"{_versions(root)}/version={version + 1}")
    return written


def _lines(spark: SparkSession, source: str, since: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", "true").option("modifiedAfter", since).text(source)
            .select("value", F.col("_metadata.file_path").alias("path")))
