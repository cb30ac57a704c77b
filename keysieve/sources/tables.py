"""Inputs derived from the driver's test tables (see FIXTURES.md).

* ``raw``        – candidate strings: tokens of ``documents.text`` plus
                   customer names, market segments and part brands;
* ``candidates`` – non-blank raw strings shorter than 20 characters, one row
                   per distinct string with its frequency;
* ``breach``     – a canonical breach-count corpus (binary SHA-1 digest, count),
                   built from tokens of ``conversations`` and ``benchmark``
                   plus every customer's name, counted once per order the
                   customer placed;
* ``flights``    – a (destination, count) table standing in for the CSV of the
                   SQL tutorial.

All of them are lazy DataFrames over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysieve.functions.text import tokens
from keysieve.operators import features
from keysieve.sources import breach as breach_src

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_tokens(spark: SparkSession, sf_dir: str, name: str, out: str = "password") -> DataFrame:
    """One row per whitespace token of ``<name>.text``."""
    return table(spark, sf_dir, name).select(F.explode(tokens("text")).alias(out))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    part = table(spark, sf_dir, "part")
    return (text_tokens(spark, sf_dir, "documents")
            .unionByName(customer.select(F.explode(F.array("c_name", "c_mktsegment")).alias("password")))
            .unionByName(part.select(F.col("p_brand").alias("password"))))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct cleaned candidates with ``freq`` (partial + final hash agg, so
    a password that makes up a third of the list is combined map-side)."""
    return (features.clean(raw(spark, sf_dir))
            .groupBy("password").agg(F.count(F.lit(1)).alias("freq")))


def breach_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(password, k) occurrences that make up the breach corpus.

    Customer names are weighted by their number of orders: orders are
    aggregated per customer first (map-side combined, so a customer holding a
    third of all orders is one partial row per mapper), then joined on the
    unique customer key."""
    customer = table(spark, sf_dir, "customer")
    orders = (table(spark, sf_dir, "orders").groupBy("o_custkey")
              .agg(F.count(F.lit(1)).alias("k")))
    names = (customer.join(orders, customer.c_custkey == orders.o_custkey)
             .select(F.col("c_name").alias("password"), "k"))
    return (text_tokens(spark, sf_dir, "conversations").withColumn("k", F.lit(1).cast("bigint"))
            .unionByName(text_tokens(spark, sf_dir, "benchmark").withColumn("k", F.lit(1).cast("bigint")))
            .unionByName(names))


def breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical breach corpus ``digest, breach_count`` (one row per digest).

    Strings are counted first, so each distinct one is hashed once."""
    src = (breach_source(spark, sf_dir).where(F.col("password") != "")
           .groupBy("password").agg(F.sum("k").alias("breach_count")))
    return src.select(F.coalesce(F.unhex(F.sha1("password")), F.lit(bytearray())).alias("digest"), "breach_count")


def breach_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as ``prefix, suffix, breach_count``."""
    return breach_src.with_range(breach(spark, sf_dir))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``DEST_COUNTRY_NAME, count``: customers per (nation, segment)."""
    customer = table(spark, sf_dir, "customer")
    # nation is a fixed 25-row dimension, so broadcasting it is bounded.
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .groupBy("n_name", "c_mktsegment")
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("n_name").alias("DEST_COUNTRY_NAME"), "count"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with flags, length, score and ``password_strength``."""
    return features.label(candidates(spark, sf_dir))
