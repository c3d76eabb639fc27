"""V4 by index: exact distances, recall against the exact path, copies and crowds."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from seclake.operators import lsh, retrieval


def search(spark, corpus, k=3, every=20, **kw):
    queries = corpus.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    index = lsh.fit(corpus, **kw)
    return lsh.search(lsh.entries(corpus, index, k), queries, index, k), retrieval.knn(corpus, queries, k), index


@pytest.mark.parametrize("base,bucket_rows", [(SF_SMALL, 64), ("/root/testdata/sf0.1", 64), ("/root/testdata/sf0.1", 16), ("/root/testdata/sf0.1", 4)])
def test_recall(spark, base, bucket_rows):
    corpus = spark.read.parquet(f"{base}/embeddings.parquet").select("vec_id", "embedding")
    found, exact, index = search(spark, corpus, k=10, bucket_rows=bucket_rows)
    share = lsh.recall(found, exact)
    print(f"rows {corpus.count()}, bits {index.medians.shape[1]}, tables {index.medians.shape[0]}, recall {share:.3f}")
    assert share >= 0.9


def test_more_bits_ask_for_more_tables(spark):
    corpus = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    few, many = lsh.fit(corpus, bucket_rows=250), lsh.fit(corpus, bucket_rows=8)
    assert len(few.medians) < len(many.medians) <= lsh.MAX_TABLES


def test_hits_are_exact(spark, scratch):
    corpus = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding")
    found, exact, index = search(spark, corpus, bucket_rows=100)
    true = {(r.query_id, r.vec_id): r.distance for r in retrieval.knn(corpus, corpus.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec")), 10**6).collect()}
    rows = found.collect()
    assert rows and all(true[r.query_id, r.vec_id] == r.distance for r in rows)
    queries = corpus.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    lsh.save(corpus, index, scratch)
    assert sorted(lsh.search(spark.read.parquet(scratch), queries, index).collect()) == sorted(rows)


def test_all_probes_find_everything(spark, monkeypatch):
    """With as many probes as buckets, few rows a part and few queries a group, the answer is the exact one, copies included."""
    monkeypatch.setattr(lsh, "PART_ROWS", 7)
    monkeypatch.setattr(lsh, "QUERY_GROUP", 3)
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) for _ in range(5)]) for i in range(120)] + [(200 + i, [0.5] * 5) for i in range(150)] + [(400, None)] + [(500 + i, [draw.choice([0.0, 1.0]) for _ in range(5)]) for i in range(60)]
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, exact, index = search(spark, corpus.where("embedding is not null"), k=4, every=10, tables=2, probes=8, bucket_rows=50)
    assert index.medians.shape[1] <= 3
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.collect()))
    whole = lsh.entries(corpus, index, 4)
    assert whole.count() == 2 * len({tuple(v) for _, v in rows if v})
    assert whole.agg(F.max(F.size("ids"))).first()[0] == 4


def drawn(spark, n=3000, d=8):
    draw = random.Random(7)
    rows = [(i, [draw.gauss(0, 1) for _ in range(d)]) for i in range(n)] + [(n + i, [0.25] * d) for i in range(300)]
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return corpus, corpus.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))


@pytest.mark.parametrize("cell_rows,cell_queries", [(32_768, 8192), (700, 90)])
def test_parts_and_buckets_find_the_same(spark, monkeypatch, cell_rows, cell_queries):
    """Cells of parts and groups, and cells of buckets (cut up as well), see the same pairs."""
    corpus, queries = drawn(spark)
    index = lsh.fit(corpus, tables=6, probes=3, bucket_rows=64)
    monkeypatch.setattr(lsh, "PART_ROWS", 20)
    monkeypatch.setattr(lsh, "QUERY_GROUP", 5)
    by_bucket = lsh.by_bucket
    monkeypatch.setattr(lsh, "by_part", lambda rows, asked, index, k, parts, groups: by_bucket(lsh.entries(corpus, index, k), asked, index, k))
    sent = sorted(map(tuple, lsh.search(lsh.entries(corpus, index, 10), queries, index, 10).collect()))
    monkeypatch.undo()
    monkeypatch.setattr(lsh, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(lsh, "CELL_QUERIES", cell_queries)
    monkeypatch.setattr(lsh, "by_bucket", None)
    assert sorted(map(tuple, lsh.search(lsh.entries(corpus, index, 10), queries, index, 10).collect())) == sent
    assert len(sent) >= 1500


def test_many_groups_go_by_bucket(spark, monkeypatch):
    """What travels is bounded by the tables and probes: with more groups than tables vectors go to their buckets."""
    corpus, queries = drawn(spark, 400)
    index = lsh.fit(corpus, tables=2, probes=4, bucket_rows=64)
    want = sorted(map(tuple, lsh.search(lsh.entries(corpus, index), queries, index).collect()))
    monkeypatch.setattr(lsh, "CELL_QUERIES", 5)
    monkeypatch.setattr(lsh, "by_part", None)
    assert sorted(map(tuple, lsh.search(lsh.entries(corpus, index), queries, index).collect())) == want


def test_vectors_travel_once_whatever_the_tables(spark, monkeypatch):
    """The rows that enter the cells do not grow with the tables: each vector once for each group, each query once for each part."""
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps
    corpus, queries = drawn(spark, 2100)
    entered, run = [], PandasCogroupedOps.applyInPandas

    def counted(self, *args):
        entered.append((self._gd1._df.count(), self._gd2._df.count()))
        return run(self, *args)
    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", counted)
    for tables in (2, 12):
        index = lsh.fit(corpus, tables=tables, bucket_rows=64)
        lsh.search(lsh.entries(corpus, index, 10), queries, index, 10)
    assert entered == [(2 * queries.count(), 2101)] * 2  # two parts, one group; equal vectors are one


def test_empty(spark):
    corpus = spark.createDataFrame([], "vec_id long, embedding array<float>")
    index = lsh.fit(corpus)
    queries = corpus.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    assert lsh.search(lsh.entries(corpus, index), queries, index).collect() == []
