"""Runbook chunking, embedding and nearest-chunk retrieval (V1–V5).

* V1 chunks every document in parallel (``mapInArrow``, or a table function; a
  small recursive splitter runs per row).
* V2 embeds with MLlib feature hashing + IDF + L2 normalisation, all
  JVM-side, or by built-in functions (``hashed_tfidf``); precomputed vectors are accepted as well.
* V4 is exact top-k: one group of queries is sent to the rows, more are dealt with them over a
  grid of groups of bounded size; each task or cell keeps its own k best per query, and a final ranking per
  query merges them. ``lsh`` has the index for corpora too large for that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Fixed values of the reference's splitter and retriever settings.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
SEPARATORS = ("\n\n", "\n", " ", "")
TOP_K = 3
QUERY_PREFIX = "Mitigation and response for: "
NO_CONTEXT = "No specific internal runbook context found."
CONTEXT_JOIN = "\n\n"
QUERY_GROUP = 512  # queries and rows in a cell of the search grid
ROW_GROUP = 4096
BLOCK_CHARS = 1 << 20  # of chunks handed on at a time


# ------------------------------------------------------------------ V1

def _merge(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Greedy packing of pieces into chunks of at most ``size`` characters,
    carrying up to ``overlap`` trailing characters into the next chunk."""
    chunks, window, total = [], [], 0
    for piece in pieces:
        if window and total + len(piece) > size:
            text = "".join(window).strip()
            if text:
                chunks.append(text)
            while window and (total > overlap or total + len(piece) > size):
                total -= len(window[0])
                window.pop(0)
        window.append(piece)
        total += len(piece)
    text = "".join(window).strip()
    if text:
        chunks.append(text)
    return chunks


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators=SEPARATORS) -> list[str]:
    """Split on the first separator present (kept at the start of the next
    piece); pieces still longer than ``size`` are split with the next
    separators; then pieces are packed with overlap."""
    if not text:
        return []
    sep, rest = separators[-1], ()
    for i, s in enumerate(separators):
        if s == "" or s in text:
            sep, rest = s, separators[i + 1:]
            break
    if sep:
        raw = text.split(sep)
        pieces = [raw[0]] + [sep + p for p in raw[1:]]
    else:
        pieces = list(text)
    pieces = [p for p in pieces if p]
    out, small = [], []
    for p in pieces:
        if len(p) <= size:
            small.append(p)
            continue
        if small:
            out.extend(_merge(small, size, overlap))
            small = []
        out.extend(split_text(p, size, overlap, rest) if rest else [p])
    if small:
        out.extend(_merge(small, size, overlap))
    return out


CHUNK_SCHEMA = T.StructType([
    T.StructField("doc_path", T.StringType()),
    T.StructField("chunk_idx", T.IntegerType()),
    T.StructField("text", T.StringType()),
])


def chunk_documents(docs: DataFrame, path_col: str = "doc_path", text_col: str = "text",
                    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """V1: ``(doc_path, text)`` → ``(doc_path, chunk_idx, text)``."""
    src = docs.select(F.col(path_col).cast("string").alias("doc_path"), F.col(text_col).alias("text"))

    return src.mapInArrow(lambda batches: chunk_batches(batches, size, overlap), CHUNK_SCHEMA)


def chunk_batches(batches: Iterator[pa.RecordBatch], size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Iterator[pa.RecordBatch]:
    """The chunks of batches of ``doc_path, text``, handed on whenever there are ``BLOCK_CHARS`` characters: what a worker holds of texts and
    chunks besides the batch that came in is bounded by that and one document, however many rows a batch has."""
    kinds = {"doc_path": pa.string(), "chunk_idx": pa.int32(), "text": pa.string()}
    held, n = {c: [] for c in kinds}, 0
    for batch in batches:
        for path, text in zip(batch.column("doc_path"), batch.column("text")):
            pieces = split_text(text.as_py() or "", size, overlap)
            held["doc_path"].extend([path.as_py()] * len(pieces))
            held["chunk_idx"].extend(range(len(pieces)))
            held["text"].extend(pieces)
            n += sum(map(len, pieces))
            if n >= BLOCK_CHARS:
                yield pa.RecordBatch.from_pydict({c: pa.array(held[c], kind) for c, kind in kinds.items()})
                held, n = {c: [] for c in kinds}, 0
    yield pa.RecordBatch.from_pydict({c: pa.array(held[c], kind) for c, kind in kinds.items()})


def split_table():
    """V1 as a table function of a text: ``chunk_idx, text``, to be joined laterally (``docs.lateralJoin(split_table()(F.col("text").outer()))``, or by name in SQL once registered)."""
    class Split:
        def eval(self, text: str):
            yield from enumerate(split_text(text or ""))
    return F.udtf(Split, returnType="chunk_idx int, chunk string", useArrow=True)


# ------------------------------------------------------------------ V2

def _counting(text_col: str, dims: int) -> list:
    from pyspark.ml.feature import HashingTF, RegexTokenizer
    return [RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"(?U)\W+", toLowercase=True),
            HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dims)]


def term_counts(chunks: DataFrame, text_col: str = "text", dims: int = 256) -> DataFrame:
    """``chunks`` with their hashed term counts ``_tf``. Written with the chunks, they let the fit and the embedding read counts, so that texts are split into words once."""
    for stage in _counting(text_col, dims):
        chunks = stage.transform(chunks)
    return chunks.drop("_tok")


def fit_embedder(chunks: DataFrame, text_col: str = "text", dims: int = 256):
    """V2 default (offline): tokens → hashed term counts → IDF → L2 norm. ``chunks`` may have ``term_counts``, of as many ``dims``."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import IDF, Normalizer
    weighing = [IDF(inputCol="_tf", outputCol="_idf"), Normalizer(inputCol="_idf", outputCol="_vec", p=2.0)]
    if "_tf" in chunks.columns:
        return PipelineModel([*_counting(text_col, dims), *Pipeline(stages=weighing).fit(chunks).stages])
    return Pipeline(stages=[*_counting(text_col, dims), *weighing]).fit(chunks)


def embed(model, df: DataFrame, out: str = "embedding") -> DataFrame:
    """``df`` with the vectors of its texts, or of its ``term_counts`` if it has them."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    model = PipelineModel(model.stages[2:]) if "_tf" in df.columns else model
    return (model.transform(df).withColumn(out, vector_to_array("_vec", "float32"))
            .drop("_tok", "_tf", "_idf", "_vec"))


def hashed_tfidf(docs: DataFrame, id_col: str, text_col: str = "text", dims: int = 256) -> DataFrame:
    """V2 by built-in functions alone: ``(id, pos, weight)``, the places of each text's unit vector that aren't zero. Words are runs of letters, digits and
    underscores in lower case; a word's place is that of its MD5; weights are counts times log((n + 1) / (df + 1)), as ``fit_embedder`` has them. Sums are partial before each
    shuffle; a text is never gathered. Texts with equal ids are one text; texts without a word, or with nothing but words that all texts have, give no rows."""
    word = F.explode(F.split(F.lower(text_col), r"[^\p{L}\p{N}_]+")).alias("word")
    place = (F.conv(F.substring(F.md5(F.encode("word", "UTF-8")), 1, 8), 16, 10).cast("long") % dims).cast("int")
    words = docs.select(F.col(id_col).alias("id"), word).where("word <> ''")
    # Written once: the places' frequencies, the weights and the norms read the counts, not the texts.
    tf = materialize(words.select("id", place.alias("pos")).groupBy("id", "pos").agg(F.count("*").alias("tf")), "tf")
    df = tf.groupBy("pos").agg(F.count("*").alias("df"))  # at most ``dims`` rows
    total = docs.agg(F.count_distinct(F.col(id_col)).alias("n"))
    idf = df.withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one").select("pos", F.log((F.col("n") + 1) / (F.col("df") + 1)).alias("idf"))
    weighted = tf.where("id is not null").join(F.broadcast(idf), "pos").select("id", "pos", (F.col("tf") * F.col("idf")).alias("w")).where("w <> 0")
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))  # at most ``dims`` rows a text
    return weighted.select("id", "pos", (F.col("w") / norm).alias("weight"))


# ------------------------------------------------------------------ V3

def retrieval_query(techniques: Column) -> Column:
    """V3: query text from an ordered technique list; null when empty."""
    return F.when(F.size(techniques) > 0, F.concat(F.lit(QUERY_PREFIX), F.array_join(techniques, ", ")))


# ------------------------------------------------------------------ V4 / V5

def _sq_l2(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared L2 distances rows × queries, summed in dimension order."""
    d = np.zeros((x.shape[0], q.shape[0]))
    for j in range(x.shape[1]):
        diff = x[:, j][:, None] - q[None, :, j]
        d += diff * diff
    return d


def knn(corpus: DataFrame, queries: DataFrame, k: int = TOP_K, id_col: str = "vec_id",
        vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "query_vec",
        query_group: int = QUERY_GROUP, row_group: int = ROW_GROUP) -> DataFrame:
    """V4: for every query the ``k`` nearest corpus rows by squared L2
    (distance rounded to 6 dp, ties by id) → ``(query_id, id, distance, rank)``.

    One group of queries (``query_group`` at most) goes to every task, which keeps the ``k`` best of
    each ``row_group`` rows it reads: the rows don't travel. More queries are dealt with the rows over a grid of groups by a hash of their ids;
    each cell holds one group of queries and one of rows, both of bounded
    size, and keeps its ``k`` best rows per query. One pass over the
    corpus whatever the number of queries, and no more than one group goes through the driver."""
    schema = T.StructType([T.StructField(qid_col, queries.schema[qid_col].dataType), T.StructField(id_col, T.LongType()),
                           T.StructField("distance", T.DoubleType())])

    def best(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(rows):
            ids = rows[id_col].to_numpy(dtype=np.int64)
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], np.vstack([np.asarray(v, dtype=np.float64) for v in rows[vec_col]])[order]
            apart = np.round(_sq_l2(x, np.vstack([np.asarray(v, dtype=np.float64) for v in asked[qvec_col]])), 6).T
            for query, d in zip(asked[qid_col], apart):
                at = np.argsort(d, kind="stable")[:k]  # ids rise, so that ties go to the smaller one
                out.append((query, ids[at], d[at]))
        return pd.DataFrame({qid_col: pd.Series([q for q, at, _ in out for _ in at], dtype=object), id_col: np.concatenate([at for _, at, _ in out]) if out else [],
                             "distance": np.concatenate([d for _, _, d in out]) if out else []})

    w = Window.partitionBy(qid_col).orderBy("distance", id_col)

    def ranked(local: DataFrame) -> DataFrame:
        return local.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)

    few = queries.select(qid_col, qvec_col).limit(query_group + 1).collect()
    if len(few) <= query_group:
        group = pd.DataFrame({qid_col: [r[0] for r in few], qvec_col: [r[1] for r in few]})
        return ranked(corpus.select(id_col, vec_col).mapInPandas(
            lambda frames: (best(group, rows[i:i + row_group]) for rows in frames for i in range(0, len(rows), row_group)), schema))
    n_q, n_c = max(1, -(-queries.count() // query_group)), max(1, -(-corpus.count() // row_group))
    asked = queries.select(qid_col, qvec_col, F.pmod(F.xxhash64(qid_col), F.lit(n_q)).alias("_q")).withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))))
    rows = corpus.select(id_col, vec_col, F.pmod(F.xxhash64(id_col), F.lit(n_c)).alias("_c")).withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))))
    return ranked(asked.groupBy("_q", "_c").cogroup(rows.groupBy("_q", "_c")).applyInPandas(best, schema))


def centroids(vectors: DataFrame, key: str, vec_col: str = "embedding") -> DataFrame:
    """Mean vector per ``key`` (a query set derived from the corpus)."""
    parts = vectors.select(key, F.posexplode(vec_col).alias("pos", "v"))
    means = parts.groupBy(key, "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return means.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("query_vec"))


def context_join(hits: DataFrame, qid_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """V5: the hit texts of each query in rank order, joined by a blank line."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", text_col)))
    return hits.groupBy(qid_col).agg(F.array_join(F.transform(ordered, lambda s: s[text_col]), CONTEXT_JOIN)
                                     .alias("context"))
