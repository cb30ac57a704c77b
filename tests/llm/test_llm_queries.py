"""Every llm query with SQL returns DuckDB's rows; the others run."""

import pytest
from oracle_compare import compare, duck

from keysieve.llm.registry import ORACLE, QUERIES, load_all

load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, sf_dir, con, name):
    info = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name], con)
    assert info["ok"], info


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("n", [4, 6, 7, 8, 9, 10, 12])
def test_one_row_per_document_at_least(spark, sf_dir, n):
    fn = next(f for q, f in QUERIES.items() if q.startswith(f"op{n}_"))
    ids = {r[0] for r in fn(spark, sf_dir).select("doc_id").collect()}
    assert ids == {r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}


def test_native_queries_have_no_python(spark, sf_dir):
    for name, fn in QUERIES.items():
        if name.split("_")[0] in ("op1", "op2", "op5", "op7"):
            plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
            assert not any(x in plan for x in ("Python", "Arrow", "Pandas")), name
