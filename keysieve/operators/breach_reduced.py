"""Breach matching that reads or moves less of the corpus than the plain join.

Both return what :func:`keysieve.operators.breach.match_breach` returns:

* :func:`match_pruned` reads only the part of a corpus store that the
  candidates' digests fall in;
* :func:`match_bloom` drops most corpus rows without a candidate before the
  corpus is shuffled, by a Bloom filter of the candidates' digests.

The candidates are hashed twice, once for their keys, which are staged without
any plaintext, and once for the match; pass a table if that is dear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.operators import bloom
from keysieve.operators.breach import match_breach, with_digest
from keysieve.operators.lineage import materialize
from keysieve.sources.corpus_store import MAX_KEYS, prune


def _hashed(candidates: DataFrame, charset: str) -> DataFrame:
    return candidates if "sha1" in candidates.columns else with_digest(candidates, charset=charset)


def match_pruned(candidates: DataFrame, store: DataFrame, how: str = "inner", max_keys: int = MAX_KEYS,
                 charset: str = "UTF-8") -> DataFrame:
    """``match_breach`` against a store of :mod:`keysieve.sources.corpus_store`,
    reading as little of it as the candidates allow."""
    c = _hashed(candidates, charset)
    return match_breach(c, prune(store, c.select(F.unhex("sha1").alias("digest")), max_keys), how=how)


def digest_filter(keys: DataFrame, error: float = 0.01, key: str = "digest") -> tuple[DataFrame, bloom.Shape]:
    """Bloom filter of the distinct values of a table's column, as a table, and
    its shape, from their number and the share of others that may pass."""
    shape = bloom.shape_for(keys.count(), error)
    return materialize(bloom.build(keys, key, shape), "bloom"), shape


def match_bloom(candidates: DataFrame, corpus: DataFrame, how: str = "inner", error: float = 0.01,
                max_bytes: int = bloom.MAX_BYTES, charset: str = "UTF-8") -> DataFrame:
    """``match_breach`` with the corpus reduced by the candidates' filter; plain
    where the filter would be over ``max_bytes``. Fires jobs."""
    c = _hashed(candidates, charset)
    keys = materialize(c.select(F.unhex("sha1").alias("digest")).where("digest is not null").distinct(), "keys")
    filter_, shape = digest_filter(keys, error)
    return match_breach(c, bloom.reduced(corpus, "digest", filter_, shape, max_bytes), how=how)
