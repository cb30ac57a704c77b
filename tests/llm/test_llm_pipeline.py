"""The pipeline against brute force, stage by stage."""

import pytest
from test_llm_decontam import brute as leaks
from test_llm_exact_dedup import brute as copies
from test_llm_simhash import brute_classes
from test_llm_tokens import check_packing

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]


def test_run_equals_brute_force(spark, sf_dir):
    from tokenizers import Tokenizer

    from keysieve.llm import toxicity
    from keysieve.llm.tokens import vocabulary
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("labels", "benchmark"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    clean = {r["doc_id"] for r in scored if not r["predicted"]}
    rows = [r for r in rows_of(docs) if r[0] in clean]
    rows = [r for r, keep in zip(sorted(rows), sorted(copies(rows), key=lambda x: x[0])) if keep[3]]
    first = {d: c for d, _, c in brute_classes(rows)}
    rows = [r for r in rows if first[r[0]] == r[0]]
    bad = {d for d, *_ in leaks(rows, [(r["item_id"], r["text"]) for r in items.collect()])}
    rows = [r for r in rows if r[0] not in bad]
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    check_packing(rows, Tokenizer.from_file(vocabulary()), packed)
    assert 0 < len(rows) < docs.count()


def test_stages_keep_columns_and_odd_rows(spark, sf_dir, documents, odd_rows):
    docs = documents(odd_rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert stage(spark, documents([]), sf_dir).isEmpty()
    kept = sorted((r[0] is None, r[0]) for r in corpus_pipeline.drop_copies(spark, docs, sf_dir).select("doc_id").collect())
    assert [d for none, d in kept if not none] == [2, 5, 6, 7, 8, 10, 11, 13, 14, 15, 16]
    assert sum(none for none, _ in kept) == 1  # "lonely"; the other text without an id is that of 6


def test_exact_copies_decide_per_row(spark, sf_dir, documents):
    rows = [(None, "a text"), (None, "a text"), (None, "at e xt"), (5, "a text"), (5, "other"), (3, "a  text"), (2, "a  text"), (None, None)]
    got = rows_of(corpus_pipeline.drop_copies(spark, documents(rows), sf_dir))
    assert sorted(got, key=str) == sorted([(2, "a  text"), (5, "other"), (None, None)], key=str)
    many = [(None, "same")] * 400 + [(None, "sa me")] * 3 + [(8, "same")]
    assert sorted(rows_of(corpus_pipeline.drop_copies(spark, documents(many), sf_dir))) == [(None, "sa me")]


def test_decontamination_decides_per_row(spark, sf_dir, documents):
    item = next(r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if len(r["text"].split()) > 9)
    rows = [(None, f"before {item} after"), (None, "a clean text of no id"), (4, item), (4, "another clean text"), (5, None)]
    got = rows_of(corpus_pipeline.drop_contaminated(spark, documents(rows), sf_dir))
    assert sorted(got, key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_near_copies_decide_per_row(spark, sf_dir, documents):
    a, b, c = (" ".join(f"{w}{i}" for i in range(200)) for w in "abc")
    rows = [(None, a), (None, a), (9, a), (None, b), (None, b + " "), (7, c), (7, c), (7, b[:300]), (8, c)]
    got = rows_of(corpus_pipeline.drop_near_copies(spark, documents(rows), sf_dir))
    assert sorted((str(d), t.strip()) for d, t in got) == sorted([("9", a), ("None", b), ("7", c), ("7", b[:300])])


def test_registered():
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
