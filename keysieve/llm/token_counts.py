"""Exact token-length histogram and what it answers for every context limit.

Documents are encoded once and only their lengths are aggregated, so the
histogram has one row per distinct length however many documents there are.
Suffix sums over it give, for a context limit L: documents and tokens of at
least L, tokens left when each document is cut at L, and the share of documents
shorter than L (so its inverse gives the quantiles). All are linear between two
neighbouring lengths, so the histogram's lengths are all the limits needed.

Suffix sums are taken inside blocks of lengths and over the blocks' totals, so
no task holds the whole histogram.

Defined results: a null or empty text has length 0; repeated rows count each;
no rows give an empty histogram; columns other than the text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keysieve.llm.common import map_batches, texts
from keysieve.llm.tokens import encoder, vocabulary
from keysieve.operators.lineage import materialize

BLOCK = 256


def lengths(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens)`` per row."""
    path = path or vocabulary()

    def start():
        ids = encoder(path).ids
        return lambda doc, text: (doc, [len(ids(t)) // 4 for t in text])

    return map_batches(texts(docs, id_col, text_col), "doc_id long, n_tokens long", start)


def histogram(counted: DataFrame) -> DataFrame:
    """``(length, n_docs)``, exact."""
    return counted.groupBy(F.col("n_tokens").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per length, as a context limit: ``context_limit, n_docs, docs_from,
    tokens_from`` (documents and tokens of that length or more),
    ``truncated_tokens`` (each document cut at the limit), ``total_tokens`` and
    ``share_below`` (documents shorter than the limit)."""
    h = hist.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"),
                    F.floor(F.col("length") / block).alias("b"))
    later = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = (h.groupBy("b").agg(F.sum("n_docs").alias("bd"), F.sum("n_tokens").alias("bt"))
              .select("b", F.coalesce(F.sum("bd").over(later), zero).alias("after_docs"),
                      F.coalesce(F.sum("bt").over(later), zero).alias("after_tokens"),
                      F.sum("bd").over(every).alias("total_docs"),
                      F.sum("bt").over(every).alias("total_tokens")))
    inside = Window.partitionBy("b").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    s = h.join(blocks, "b").select(
        "length", "n_docs", (F.sum("n_docs").over(inside) + F.col("after_docs")).alias("docs_from"),
        (F.sum("n_tokens").over(inside) + F.col("after_tokens")).alias("tokens_from"),
        "total_docs", "total_tokens")
    return s.select(F.col("length").alias("context_limit"), "n_docs", "docs_from", "tokens_from",
                    (F.col("total_tokens") - F.col("tokens_from") + F.col("docs_from") * F.col("length"))
                    .alias("truncated_tokens"), "total_tokens",
                    (1 - F.col("docs_from") / F.col("total_docs")).alias("share_below"))


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``suffix_sums`` of the documents' histogram."""
    return suffix_sums(materialize(histogram(lengths(docs, path, id_col, text_col)), "length-histogram"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share ``q`` of documents do not exceed."""
    reach = (F.col("docs_from") - F.col("n_docs")) <= (1 - q) * F.col("docs_from") / (1 - F.col("share_below"))
    return sums.where(reach).agg(F.min("context_limit").alias("length"))


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is cut at ``limit`` (any number)."""
    over = F.col("context_limit") >= limit
    from_limit = lambda c: F.coalesce(F.max(F.when(over, F.col(c))), F.lit(0))
    return sums.agg((F.coalesce(F.max("total_tokens"), F.lit(0)) - from_limit("tokens_from")
                     + from_limit("docs_from") * limit).alias("tokens"))
