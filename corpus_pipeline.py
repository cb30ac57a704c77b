"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written and read again as the next one's docs.
All but the last keep the columns of ``documents``. Every stage decides per row,
whatever its id: rows without an id and rows that repeat one are kept or dropped
each by its own text, and of equal texts one row stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keysieve.llm import decontam, exact_dedup, packing, simhash, toxicity
from keysieve.llm.common import keep_ids, table, with_package
from keysieve.operators.lineage import materialize

#: SQL can express neither the toxicity model nor the fingerprints: tested against brute force.
ORACLE_SQL = None
#: Column of a row's number inside a stage.
ROW = "__row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row, written, so that the numbers are fixed from then on."""
    return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def first_of_each(rows: DataFrame, groups: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` without those that are not the first, by ``order``, of their
    group in ``groups(row, group)``."""
    ids = rows.select(F.col(ROW).alias("row"), F.struct(*order, F.col(ROW).alias("row")).alias("place"))
    members = materialize(groups.join(ids, "row"), "members")
    # Written, so that both sides of the join are plain shuffles, whose hot partitions Spark splits.
    kept = materialize(members.groupBy("group").agg(F.min("place")["row"].alias("kept"), F.count(F.lit(1)).alias("n"))
                       .where("n > 1"), "kept")
    gone = members.join(kept, "group").where("row <> kept").select(F.col("row").alias("doc_id"))
    return keep_ids(rows, gone, "left_anti", ROW).drop(ROW)


def smallest_id() -> list[Column]:
    """Order by id, null last."""
    return [F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id")]


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the most code points, then the smallest id."""
    rows = numbered(docs)
    copies = exact_dedup.exact_dedup(rows, id_col=ROW).where("group_size > 1")
    groups = copies.select(F.col("doc_id").alias("row"), F.col("keep_id").alias("group"))
    points = -F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return first_of_each(rows, groups, [points.alias("points"), *smallest_id()])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each class of linked fingerprints."""
    rows = numbered(docs)
    classes = simhash.simhash_classes(rows, id_col=ROW).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    return first_of_each(rows, classes, smallest_id())


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; equal texts hold the same."""
    hits = decontam.contained(docs, table(spark, sf_dir, "benchmark"), digest=True).select("text_sha256").distinct()
    return docs.join(hits, decontam.text_digest(F.col("text")) == hits["text_sha256"], "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit sequences of what is left."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(with_package(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
