import hashlib
import re

from pyspark.sql import functions as F

from keysieve.llm import exact_dedup as E


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out = []
    for (d, _), n in zip(rows, norm):
        group = [(-len(t or ""), x is None, x or 0) for (x, t), m in zip(rows, norm) if m == n]
        _, none, keep = min(group)
        keep = None if none else keep
        out.append((d, keep, len(group), d == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in E.exact_dedup(df, **kw).collect()), key=str)


def test_odd_rows(documents, odd_rows):
    assert run(documents(odd_rows)) == brute(odd_rows)


def test_identifiers_that_collide_are_replaced(documents, odd_rows):
    weak = (lambda c: F.pmod(F.xxhash64(c), F.lit(3)), F.xxhash64)
    pattern = E.chunk_pattern(4, 16)
    t = documents(odd_rows).selectExpr("doc_id", "coalesce(text, '') as text")
    assert E.verified_identifier(t, pattern, weak) is weak[1]
    assert run(documents(odd_rows), pattern=pattern, identifiers=weak) == brute(odd_rows)


def test_chunks_join_to_the_text_and_follow_content(documents, odd_rows):
    long = odd_rows[10][1].replace(" ", "")
    df = documents([(0, long), (1, "inserted" + long)])
    a, b = (r[0] for r in df.orderBy("doc_id").select(E.chunks(F.col("text"), E.chunk_pattern())).collect())
    assert "".join(a) == long and "".join(b) == "inserted" + long
    assert all(E.MIN_CHUNK <= len(c) <= E.MAX_CHUNK for c in a[:-1])
    assert len(set(a) & set(b)) > 0.8 * len(a)


def test_empty_table(documents):
    out = E.exact_dedup(documents([]))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.isEmpty()


def test_large_group(documents):
    rows = [(i, "same text") for i in range(3000)] + [(-1, "same  text")]
    out = E.exact_dedup(documents(rows)).groupBy("keep_id", "group_size").agg(F.sum(F.col("kept").cast("int"))).collect()
    assert [tuple(r) for r in out] == [(-1, 3001, 1)]
