"""Cutting lineage before fan-out or iteration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keysieve.config import checkpoint_dir, scratch_path


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the session's checkpoint dir and
    return a scan of it.

    Use it where one expensive frame feeds several branches or the many
    passes of a model fit: they then read the written table instead of
    re-running the pipeline, and a lost executor recomputes from that table.
    (An eager ``checkpoint()`` of an unpersisted frame computes it twice:
    once for its count and once more to write the checkpoint files; the
    table write computes it once and stores it compressed and columnar, by the
    session's codec if none is named.)"""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.parquet(path)


def clean_scratch(spark: SparkSession) -> bool:
    """Delete everything that this library staged under the session's
    checkpoint dir. Call it when no frame that reads a staged table is needed
    any more; true if there was something to delete."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/keysieve")
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
