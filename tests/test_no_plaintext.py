"""Queries that stage intermediate tables write no passwords to scratch."""

import os

import pyarrow.parquet as pq
import pytest

from keysieve.config import checkpoint_dir
from keysieve.plans.registry import QUERIES, load_all

load_all()

STAGING = ["breach_match_broadcast", "breach_bloom_match", "breach_watchlist", "balanced_train", "native_sample",
           "heavy_hitters", "exposure_set_sizes", "scored_set"]


def staged_files(spark):
    root = checkpoint_dir(spark).removeprefix("file:") + "/keysieve"
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("name", STAGING)
def test_no_plaintext_in_scratch(spark, sf_dir, name):
    before = staged_files(spark)
    QUERIES[name](spark, sf_dir).count()
    for f in staged_files(spark) - before:
        names = pq.read_schema(f).names
        assert not {"password", "item", "text", "word"} & set(names), (f, names)
