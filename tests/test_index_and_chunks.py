"""The search index against the plain search, the splitter as a table function, and TF-IDF by built-ins."""

import math
import re
from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from seclake.operators import forest, reports, retrieval, searchindex
from seclake.plans import detection
from seclake.session import materialize
from seclake.sources import fixtures

TERMS = ["t1110", "USER", "user_1", "10.", "10.0.1", "192.168", "h", "HI", "medium", "Brute Force", "brute  force", "_", "é", "İ", "null", "a, T", "T1021 - Remote Services", "zzz", " ", "9"]


def test_search_equals_the_plain_one(spark):
    rows = detection.analyze(fixtures.raw_logs(spark, SF_SMALL), model="none").select("log_id", *searchindex.FIELDS)
    fields = ", ".join(f"{c} string" for c in searchindex.FIELDS)
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "Ünal İ", "", "aaa", "null"), (-3, "aaaa", "10.0.1", None, "a, T1")], "log_id long, " + fields)
    rows = materialize(rows.unionByName(odd), "rows")
    index = searchindex.build(rows)
    some = 0
    for term in TERMS:
        want = sorted(r.log_id for r in reports.incident_search(rows, term).collect())
        got = searchindex.search(rows, index, term)
        assert got.columns == rows.columns and sorted(r.log_id for r in got.collect()) == want, term
        some += bool(want)
    assert some > 12 and searchindex.search(rows, index, "").count() == rows.count()
    empty = searchindex.build(rows.limit(0))
    assert searchindex.search(rows.limit(0), empty, "abc").collect() == []


def test_the_table_function_gives_the_same_chunks(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_path"), "text")
    docs = docs.unionByName(spark.createDataFrame([("none", None), ("empty", ""), ("long", "x" * 2000)], "doc_path string, text string"))
    split = retrieval.split_table()
    got = docs.lateralJoin(split(F.col("text").outer())).select("doc_path", "chunk_idx", "chunk")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, retrieval.chunk_documents(docs).collect()))


def test_tfidf(spark):
    texts = {1: "a b b é_1", 2: "A c!", 3: "", 4: None, 5: "b b b b"}
    got = retrieval.hashed_tfidf(spark.createDataFrame(list(texts.items()), "id long, text string"), "id", dims=16).collect()
    tf = {i: Counter(int(md5(w.encode()).hexdigest()[:8], 16) % 16 for w in re.findall(r"\w+", (t or "").lower())) for i, t in texts.items()}
    df = Counter(p for c in tf.values() for p in c)
    want = {}
    for i, c in tf.items():
        w = {p: n * math.log(6 / (df[p] + 1)) for p, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want |= {(i, p): x / norm for p, x in w.items() if x}
    assert {(r.id, r.pos): pytest.approx(r.weight) for r in got} == want


def test_the_walk_sees_a_wrong_score(spark):
    """The check's independent score is the fast one, and differs once a node is changed."""
    feats = materialize(detection.features_of(fixtures.raw_logs(spark, SF_SMALL)).limit(100), "features")
    nodes, psi = forest.fit_nodes(feats)
    nodes = materialize(nodes, "nodes")
    fast = {r.log_id: r.s for r in forest.score(feats, forest.Forest.from_nodes(nodes.toPandas(), psi), "s").collect()}
    slow = {r.log_id: r.walked for r in forest.walk(feats, nodes, psi).collect()}
    assert slow == {k: pytest.approx(v, abs=1e-12) for k, v in fast.items()}
    changed = nodes.withColumn("threshold", F.when(F.col("node_id") == 0, F.col("threshold") + 1e6).otherwise(F.col("threshold")))
    assert any(abs(r.walked - fast[r.log_id]) > 1e-3 for r in forest.walk(feats, changed, psi).collect())


def test_sparse_embedding_reads_the_texts_once(spark):
    """V2 by built-in functions: frequencies, weights and norms come from the saved counts; a text read for each of them would be split three times."""
    docs = spark.createDataFrame([(1, "a b b c"), (2, "a a d"), (2, "e b"), (3, None), (None, "a b")], "doc_id long, text string")
    found = retrieval.hashed_tfidf(docs, "doc_id")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "Window" in plan
    norms = {}
    for r in found.collect():
        norms[r.id] = norms.get(r.id, 0) + r.weight ** 2
    assert set(norms) == {1, 2} and all(abs(x - 1) < 1e-9 for x in norms.values())


def test_chunks_leave_in_bounded_blocks():
    """V1: a batch of many long texts is not held as chunks all at once."""
    import pyarrow as pa
    texts = [f"document {k} " + "some words here " * 400 for k in range(2000)] + ["", None]
    batch = pa.RecordBatch.from_pydict({"doc_path": [str(k) for k in range(len(texts))], "text": texts})
    out = list(retrieval.chunk_batches(iter([batch])))
    assert max(sum(len(t) for t in b.column("text").to_pylist()) for b in out) <= retrieval.BLOCK_CHARS + 2 * max(len(t or "") for t in texts)
    got = [(r["doc_path"], r["chunk_idx"], r["text"]) for b in out for r in b.to_pylist()]
    assert got == [(str(k), i, c) for k, t in enumerate(texts) for i, c in enumerate(retrieval.split_text(t or ""))]
