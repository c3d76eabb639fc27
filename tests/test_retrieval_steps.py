"""V2–V5 and G3 at size: what is split, counted or moved once for a text, a chunk or a group of queries."""

import random

import pytest
from pyspark.sql import functions as F

from seclake.operators import guardrails, retrieval
from seclake.plans import context


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def chunks(spark):
    draw = random.Random(3)
    words = ["brute", "force", "T1110", "kerberos", "ticket", "Élan", "spray", "reset", "x_1", ""]
    return spark.createDataFrame([(f"d{i % 40}", i, " ".join(draw.choices(words, k=draw.randint(0, 30)))) for i in range(400)], "doc_path string, chunk_idx int, text string")


def test_counts_written_with_the_chunks_change_nothing(spark, chunks):
    counted = retrieval.term_counts(chunks)
    assert counted.columns == [*chunks.columns, "_tf"]
    plain, given = retrieval.fit_embedder(chunks), retrieval.fit_embedder(counted)
    want = sorted((r.doc_path, r.chunk_idx, r.embedding) for r in retrieval.embed(plain, chunks).collect())
    assert sorted((r.doc_path, r.chunk_idx, r.embedding) for r in retrieval.embed(given, counted).collect()) == want
    assert sorted((r.doc_path, r.chunk_idx, r.embedding) for r in retrieval.embed(given, chunks).collect()) == want
    assert retrieval.embed(given, counted).columns == retrieval.embed(plain, chunks).columns


@pytest.mark.parametrize("dims", [3])
def test_one_group_of_queries_goes_to_the_rows(spark, dims):
    draw = random.Random(5)
    corpus = spark.createDataFrame([(i, [float(draw.randint(0, 4)) for _ in range(dims)]) for i in range(500)], "vec_id long, embedding array<float>").repartition(7)
    queries = spark.createDataFrame([(f"q{i}", [draw.random() for _ in range(dims)]) for i in range(9)] + [("same", [1.0] * dims)], "query_id string, query_vec array<double>")
    few, grid = retrieval.knn(corpus, queries, k=4, row_group=11), retrieval.knn(corpus, queries, k=4, query_group=3, row_group=11)
    assert "MapInPandas" in plan(few) and "CoGroups" not in plan(few) and "CoGroups" in plan(grid)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, grid.collect()))
    assert few.count() == 40
    assert retrieval.knn(corpus, queries.limit(0), k=4).collect() == [] == retrieval.knn(corpus.limit(0), queries, k=4).collect()


def test_patterns_run_once_for_each_text(spark):
    rows = [(i, "HIGH" if i % 3 else "LOW", ["T1110 - Brute Force, T1059 - Command", "  T1021 -  Remote\nT1110 - Brute Force", None, "", "odd one"][i % 5], f"m{i % 2}") for i in range(60)]
    analyzed = spark.createDataFrame(rows, "log_id long, final_risk_level string, mitre_techniques string, machine string")
    got = [r.technique for r in guardrails.allowed_techniques(analyzed).orderBy("rank").collect()]
    assert got == ["T1021 - Remote", "T1059 - Command", "T1110 - Brute Force", "odd one"]
    by_machine = guardrails.allowed_techniques(analyzed, scope=("machine",))
    assert sorted((r.machine, r.technique) for r in by_machine.collect()) == sorted((m, t) for m in ("m0", "m1") for t in got)
    text = plan(by_machine)
    assert "Aggregate" in text[text.index("Generate"):]  # below the split


def test_hits_go_to_the_texts(spark, chunks):
    analyzed = spark.createDataFrame([(1, "HIGH", "T1110 - Brute Force"), (2, "LOW", "T1558.003 - Kerberoasting")], "log_id long, final_risk_level string, mitre_techniques string")
    plain = context.runbook_context(analyzed, chunks)
    assert plain.collect() == context.runbook_context(analyzed, retrieval.term_counts(chunks)).collect()
    assert "strategy=broadcast" in plan(plain)
    assert plain.select(F.length("context") > 0).first()[0]
