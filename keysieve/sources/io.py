"""Parquet / CSV sinks and sources, skip-if-present stages, partitioned parts.

Writers fire exactly one job. A writer never targets the path it reads from
(``assert_not_reading``): overwriting the input of the running plan deletes
its files before they are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLIGHTS_SCHEMA = "DEST_COUNTRY_NAME STRING, count BIGINT"


def _qualified(spark: SparkSession, path: str):
    """Path with scheme and authority, as its file system spells it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p)


def root_paths(df: DataFrame) -> list[str]:
    """Paths that the plan's file scans were given (not the files in them)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            paths = relation.location().rootPaths()
            out += [paths.apply(k).toString() for k in range(paths.size())]
    return out


def assert_not_reading(df: DataFrame, path: str) -> None:
    """Refuse to write over a path that the plan reads, or a folder around it
    or in it. Only the scans' root paths are compared."""
    spark = df.sparkSession
    target = _qualified(spark, path).toString().rstrip("/") + "/"
    for p in root_paths(df):
        source = _qualified(spark, p).toString().rstrip("/") + "/"
        if source.startswith(target) or target.startswith(source):
            raise ValueError(f"refusing to overwrite {path}: the plan reads from {p}")


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    if mode == "overwrite":
        assert_not_reading(df, path)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Plain Parquet scan: no forced repartition, so the scan keeps its
    file-split parallelism and column/predicate pushdown."""
    return spark.read.parquet(path)


def has_success_marker(spark: SparkSession, path: str) -> bool:
    """True when ``path/_SUCCESS`` exists (checked through Hadoop's FS API,
    so it works for any cluster file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return bool(p.getFileSystem(conf).exists(p))


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame],
          partition_by: list[str] | None = None) -> DataFrame:
    """Read ``path`` if a finished output is there; else build, write, read.

    Writing to shared storage also cuts the lineage, so a lost executor later
    recomputes from this table instead of from the start of the pipeline."""
    if not has_success_marker(spark, path):
        write_parquet(build(), path, mode="overwrite", partition_by=partition_by)
    return read_parquet(spark, path)


def write_parts(df: DataFrame, path: str, n: int, key: str = "password",
                mode: str = "errorifexists") -> None:
    """Write ``n`` deterministic parts as ``split_id=k`` directories in one job;
    readers prune to the parts they need."""
    from keysieve.operators.sampling import split_ids
    write_parquet(split_ids(df, n, key), path, mode=mode, partition_by=["split_id"])


def read_part(spark: SparkSession, path: str, split_id: int) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split_id") == split_id)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = FLIGHTS_SCHEMA,
             infer: bool = False) -> DataFrame:
    """CSV with a header. An explicit schema avoids the extra inference pass
    over the whole input; ``infer=True`` reproduces ``inferSchema``."""
    r = spark.read.option("header", True)
    if infer or schema is None:
        return r.option("inferSchema", True).csv(path)
    return r.schema(schema).csv(path)
