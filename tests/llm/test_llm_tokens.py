import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keysieve.llm import packing as P
from keysieve.llm import token_counts as C
from keysieve.llm.tokens import encoder, vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary())


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="   \t\n\r\x0b\x1c\x85 'abzÀéſ09!?.,ñı<|>stlve-́😀", max_size=30)))
def test_ids_equal_the_tokenizers(text):
    e = encoder(vocabulary())
    want = e.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(e.ids(text), "<u4").tolist() == want


def test_the_fast_way_is_taken(sf_dir):
    assert encoder(vocabulary()).fast is not None
    assert encoder(vocabulary("word_bpe_49k.json")).fast is None


def test_whole_table(spark, sf_dir):
    e = encoder(vocabulary())
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        assert e.ids(r[0]) == e.whole(r[0])


def test_special_string_is_left_to_the_tokenizer(tokenizer):
    text = "a <|endoftext|> b\n<|endoftext|>  c"
    assert np.frombuffer(encoder(vocabulary()).ids(text), "<u4").tolist() == ids(tokenizer, text)


def test_counts_and_suffix_sums(documents, odd_rows, tokenizer):
    want = [len(ids(tokenizer, t)) for _, t in odd_rows]
    got = {r["context_limit"]: r for r in C.token_counts(documents(odd_rows)).collect()}
    assert set(got) == set(want)
    for limit, r in got.items():
        assert r["n_docs"] == want.count(limit) and r["docs_from"] == sum(n >= limit for n in want)
        assert r["tokens_from"] == sum(n for n in want if n >= limit) and r["total_tokens"] == sum(want)
        assert r["truncated_tokens"] == sum(min(n, limit) for n in want)
        assert r["share_below"] == pytest.approx(sum(n < limit for n in want) / len(want))


def test_quantiles_and_any_limit(documents, odd_rows, tokenizer):
    want = sorted(len(ids(tokenizer, t)) for _, t in odd_rows)
    sums = C.token_counts(documents(odd_rows)).cache()
    for q in (0.1, 0.5, 0.9, 1.0):
        length = next(n for n in want if sum(m <= n for m in want) >= q * len(want) - 1e-9)
        assert C.quantile(sums, q).first()[0] == length
    for limit in (0, 1, 7, 100, 10**6):
        assert C.truncated_total(sums, limit).first()[0] == sum(min(n, limit) for n in want)


def test_no_documents(documents):
    assert C.token_counts(documents([])).isEmpty() and P.pack_documents(documents([])).isEmpty()


def test_best_fit_equals_a_plain_search():
    r = random.Random(2)
    for _ in range(150):
        lengths = np.array([r.randint(1, 1024) for _ in range(r.randint(0, 60))], np.int64)
        room = []
        for k in np.argsort(-lengths, kind="stable"):
            fit = [(x, i) for i, x in enumerate(room) if x >= lengths[k]]
            if not fit:
                room.append(1024)
            i = min(fit)[1] if fit else len(room) - 1
            room[i] -= lengths[k]
        bins, offsets = P.best_fit(lengths)
        n = bins.max(initial=-1) + 1
        assert sorted(room) == sorted(1024 - np.bincount(bins, weights=lengths, minlength=n)[:n])
        for b in range(n):
            parts = sorted((offsets[k], lengths[k]) for k in np.flatnonzero(bins == b))
            assert [o for o, _ in parts] == np.cumsum([0, *(x for _, x in parts)])[:-1].tolist()


def check_packing(rows, tokenizer, packed):
    want = defaultdict(list)
    for d, t in rows:
        full = [*ids(tokenizer, t), 2]
        first = len(full) % 1024 or 1024
        cuts = [0, *range(first, len(full) + 1, 1024)]
        want[d] += [(d, k, a, b - a, zlib.crc32(np.array(full[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in packed), key=str) == sorted((x for v in want.values() for x in v), key=str)
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins), sum(r["length"] for r in packed)


def test_pack_documents(documents, odd_rows, tokenizer):
    n, total = check_packing(odd_rows, tokenizer, P.pack_documents(documents(odd_rows)).collect())
    assert n <= -(-total // 1024) + 2


def test_pack_in_groups(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_packing(rows, tokenizer, P.pack_documents(docs, group=50).collect())
    n, total = check_packing(rows, tokenizer, P.pack_documents(docs).collect())
    assert n <= 1.01 * -(-total // 1024) + 1


def test_equal_rows_without_an_id_are_spread(spark):
    docs = spark.range(100_000).selectExpr("cast(null as long) as doc_id", "'one two three' as text")
    packed = P.pack_documents(docs, group=1000)
    sizes = [r["count"] for r in packed.groupBy((F.col("sequence_id") % 100).alias("g")).count().collect()]
    assert sum(sizes) == 100_000 and len(sizes) == 100 and max(sizes) <= 2000
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("offset").alias("last")).collect()
    assert all(r["n"] <= 1024 for r in used) and len(used) <= 1.01 * sum(r["n"] for r in used) / 1024 + 100


def test_sequences_hold_the_documents(documents, tokenizer):
    rows = [(i, "one two three " * i) for i in range(0, 700, 50)]
    docs = documents(rows)
    packed = P.pack_documents(docs).cache()
    seq = {r["sequence_id"]: list(r["ids"]) for r in P.sequences(docs, packed).collect()}
    for d, t in rows:
        got = []
        for r in packed.where(F.col("doc_id") == d).orderBy("piece").collect():
            got += seq[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert got == [*ids(tokenizer, t), 2]
