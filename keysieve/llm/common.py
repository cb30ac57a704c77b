"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def with_package(spark: SparkSession) -> SparkSession:
    """In local mode, lets Python workers import this package wherever the
    program was started. On a cluster the package is shipped by the submitter
    (``--py-files`` or an installed package)."""
    sc = spark.sparkContext
    if sc.master.startswith("local") and "cluster" not in sc.master and not getattr(sc, "_keysieve_added", False):
        sc.addFile(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), recursive=True)
        sc._keysieve_added = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``(doc_id, text)``; a null text is empty. Selecting first keeps
    columns of any other name out of the operators' way."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def id_bucket(id_col: str, n: int) -> Column:
    """``crc32(id as text) mod n``: the fold of a document."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n).cast("long"))


def keep_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi",
             id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is (``left_semi``) or is not (``left_anti``)
    in ``ids.doc_id``; all columns stay, a null id matches a null id."""
    k = ids.select(F.col("doc_id").alias("__keep_id")).distinct()
    return docs.join(k, docs[id_col].eqNullSafe(k["__keep_id"]), how)


def map_batches(df: DataFrame, schema: str, start: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """``mapInArrow`` over columns as Python lists (so a null id keeps its
    neighbours exact). ``start()`` runs once per task and returns a function
    from the input columns to the output columns of one batch."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for b in batches:
            out = step(*(c.to_pylist() for c in b.columns))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)
