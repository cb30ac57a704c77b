"""Benchmark decontamination: which documents hold which test items.

An item is found when a document holds at least ``threshold`` of the item's
distinct five-word shingles (containment, so the document's length plays no
part). An item of one to four words has one shingle, all its words, and is found
in every document that holds them in a row. Candidates come from MinHash sketches: an item's sketch is the smallest
hashes of its shingles, and how many depends on the item's size. Items are
partitioned by size q, and a document that holds enough of an item misses at
most ``q - ceil(threshold * q)`` shingles, so one sketch entry more than that
is always hit: the search loses no pair. A document's shingle hashes are probed
against the sketches, and every candidate pair is then verified by counting the
item's shingles, as text, in the document.

The search shuffles candidate pairs only: sketch entries are broadcast, in as
many blocks as keep a broadcast small. Document text is not shuffled unless
there are more candidates than may be broadcast.

A document is probed with shingles of five words, and with shorter ones of
those lengths only that short items have.

Words are runs of letters and digits, lower-cased. Defined results: a document
of fewer words than an item's shingles does not hold it; texts without a word (null, empty) hold nothing and are found nowhere; repeated
rows and items of equal id count once; shingles count once however often they
occur; an empty table on either side gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysieve.llm.common import texts
from keysieve.operators.lineage import materialize

SHINGLE, THRESHOLD = 5, 0.8
#: Sketch entries broadcast at once (16 bytes each); candidates, and shingles of items, up to
#: which their tables are broadcast. Beyond, they are joined by shuffles.
BLOCK_ENTRIES, MAX_BROADCAST, BROADCAST_SHINGLES = 500_000, 500_000, 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def starts(w: Column, k: int | Column) -> Column:
    """First word of each shingle; a shorter array has one, an empty one none."""
    none = F.slice(F.array(F.lit(0)), 1, 0)
    return F.when(F.size(w) == 0, none).otherwise(
        F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))))


def shingle_hashes(w: Column, k: int) -> Column:
    return F.transform(starts(w, k), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k))))


def shingle_texts(w: Column, k: int | Column) -> Column:
    return F.transform(starts(w, k), lambda i: F.array_join(F.slice(w, i + 1, k), " "))


def missing_allowed(q: Column, threshold: float) -> Column:
    """Shingles of q that a match may lack."""
    return q - F.ceil(q * F.lit(threshold) - F.lit(1e-9))


def sketches(items: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per item: ``item_id, width`` (words of a shingle), ``shingles`` (distinct
    texts), ``n_shingles, size_class`` (power of two) and ``sketch``, its smallest hashes."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    s = w.select("item_id", F.least(F.size("w"), F.lit(k)).alias("width"),
                 F.array_distinct(shingle_texts(F.col("w"), k)).alias("shingles"),
                 F.sort_array(F.array_distinct(shingle_hashes(F.col("w"), k))).alias("hashes"))
    s = s.distinct().withColumn("n_shingles", F.size("shingles"))
    s = s.withColumn("size_class", F.floor(F.log2("n_shingles")))
    # One length for a size class: what its largest item may lack, and one.
    most = F.least(F.col("n_shingles"), missing_allowed(F.pow(F.lit(2), F.col("size_class") + 1) - 1, threshold) + 1)
    return s.select("item_id", "width", "shingles", "n_shingles", "size_class",
                    F.slice("hashes", 1, most.cast("int")).alias("sketch"))


def candidates(docs: DataFrame, entries: DataFrame, widths: Sequence[int], block_entries: int) -> DataFrame:
    """Distinct ``(doc_key, item)`` pairs of ``docs(doc_key, w)``, cut into
    shingles of each of ``widths`` words, and ``entries(h, item)`` with a common hash. Entries are broadcast in blocks of
    hash values, so that a broadcast has about ``block_entries`` rows."""
    hashes = F.concat(*(shingle_hashes(F.col("w"), k) for k in widths))
    probes = docs.select("doc_key", F.explode(F.array_distinct(hashes)).alias("h"))
    n_blocks = max(1, math.ceil(entries.count() / block_entries))
    found = (probes.join(F.broadcast(entries.where(F.pmod("h", F.lit(n_blocks)) == b)), "h").select("doc_key", "item")
             for b in range(n_blocks))
    return reduce(DataFrame.unionByName, found).distinct()


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """A written table, broadcast if it has at most ``rows`` rows; a larger one
    is joined as the planner sees fit."""
    return F.broadcast(df) if df.count() <= rows else df


def contained(docs: DataFrame, items: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD,
              block_entries: int = BLOCK_ENTRIES, id_col: str = "doc_id", text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text", digest: bool = False) -> DataFrame:
    """Pairs ``doc_id, item_id, shared, n_shingles, containment``; with
    ``digest`` also ``text_sha256``, which tells rows of one id apart."""
    bench = texts(items, item_id_col, item_text_col).withColumnRenamed("doc_id", "item_id")
    # Numbered when written: the numbers are fixed from then on.
    sk = materialize(sketches(bench, k, threshold).withColumn("item", F.monotonically_increasing_id()), "sketches")
    # Equal keys of different documents only add candidates, which are verified.
    keyed = texts(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("doc_key"))
    split = keyed.select("doc_id", "doc_key", words(F.col("text")).alias("w"))
    # At most one row per length; without short items there are no shorter probes.
    widths = sorted({k, *(r["width"] for r in sk.select("width").distinct().collect())})
    found = materialize(candidates(split, sk.select("item", F.explode("sketch").alias("h")), widths, block_entries),
                        "candidates")
    own = [text_digest(F.col("text")).alias("text_sha256")] if digest else []
    # Only documents with a candidate are read further.
    pairs = keyed.join(broadcast_up_to(found, MAX_BROADCAST), "doc_key").select(
        "doc_id", *own, "item", words(F.col("text")).alias("w"))
    shingled = sk.select("item", "item_id", "width", "shingles", "n_shingles")
    few = (sk.agg(F.sum("n_shingles")).first()[0] or 0) <= BROADCAST_SHINGLES
    pairs = pairs.join(F.broadcast(shingled) if few else shingled, "item")
    shared = F.size(F.array_intersect("shingles", shingle_texts(F.col("w"), F.col("width"))))
    named = ["text_sha256"] if digest else []
    return (pairs.select("doc_id", "item_id", shared.alias("shared"), "n_shingles", *named)
            .where(F.col("shared") >= F.col("n_shingles") * threshold - 1e-9).distinct()
            .select("doc_id", "item_id", "shared", "n_shingles",
                    (F.col("shared") / F.col("n_shingles")).alias("containment"), *named))
