"""Runbook context for a report (V2–V5 end to end).

The allowed techniques of the high-risk rows form the query text (V3); it
is embedded with the same model as the chunks (V2), the nearest chunks
are found (V4) and joined into the context (V5). No techniques → the
fixed "no context" sentence and no search.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import guardrails, retrieval
from ..session import materialize


def query_texts(analyzed: DataFrame, scope: tuple = ()) -> DataFrame:
    """One query per scope (the whole run when ``scope`` is empty)."""
    techs = guardrails.allowed_techniques(analyzed, scope=scope)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "technique"))), lambda s: s["technique"])
    return techs.groupBy(*scope).agg(ordered.alias("techniques")).select(
        *scope, retrieval.retrieval_query(F.col("techniques")).alias("query_text"))


def runbook_context(analyzed: DataFrame, chunks: DataFrame, k: int = retrieval.TOP_K) -> DataFrame:
    """→ one row ``(query_text, context)``. ``chunks`` may have ``retrieval.term_counts``."""
    spark = analyzed.sparkSession
    queries = materialize(query_texts(analyzed), "queries")  # one row, read by the check and the embedding
    q = queries.where(F.col("query_text").isNotNull())
    if q.limit(1).count() == 0:
        return spark.createDataFrame([(None, retrieval.NO_CONTEXT)], "query_text string, context string")
    model = retrieval.fit_embedder(chunks)
    corpus = retrieval.embed(model, chunks.withColumn("chunk_id", F.xxhash64("doc_path", "chunk_idx")))
    qv = retrieval.embed(model, q.withColumnRenamed("query_text", "text")).select(
        F.col("text").alias("query_id"), F.col("embedding").alias("query_vec"))
    hits = retrieval.knn(corpus, qv, k=k, id_col="chunk_id")  # ``k`` rows, as there is one query: they go to the texts
    return retrieval.context_join(corpus.select("chunk_id", "text").join(F.broadcast(hits), "chunk_id")).select(F.col("query_id").alias("query_text"), "context")
