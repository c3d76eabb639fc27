"""Exact top-k inner products by distributed histogram selection.

1. Vectors become integers, floor(``scale`` * x). Queries and candidates are
   dealt over a grid of groups by a hash of the row; each cell holds one
   group of queries and one of candidates, both of bounded size, and scores
   every pair by a matrix product. No cell needs another, and no score leaves it.
2. Every query has a window of scores, at first all that its norm and the
   largest candidate norm allow. A pass cuts the windows into ``BINS`` bins,
   counts the scores of each cell by bin, and sums the counts over the cells;
   the bin in which the kth largest score lies becomes the next window. A
   cell sends only the bins from its own kth score up, as lower ones can't
   hold the global one, so at most k rows a query.
3. When all windows are one score wide, that score is the kth value. The last
   pass sends the scores above it and, of those equal to it, each cell's k
   smallest ids; ranks by (score, id) settle the ties.

Vectors that are null, or hold null or non-finite components, take no part.
A shorter vector counts as filled up with zeros. Scores are whole 64-bit
numbers; if the norms of queries and candidates allow one beyond 2^62, the run
stops with a ValueError. Rows with a query's id are not its candidates; if an
id is repeated among the queries, its first vector (by value) asks. Null ids
are candidates (behind all others of the same score), not queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seclake.llm.common import free_name, unit_hash
from seclake.session import materialize

BINS = 4096
QUERY_GROUP = 512
CANDIDATE_GROUP = 2048
#: Scores and the differences between them have to stay in 64 bits.
LARGEST = float(1 << 62)
NO_ID = np.iinfo(np.int64).max


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """Whole components. One beyond a long saturates, which ``top_k`` refuses."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where no sum can reach 2^53."""
    if queries.size and candidates.size and float(np.abs(queries).max()) * float(np.abs(candidates).max()) * queries.shape[1] < 2.0 ** 53:
        return (queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    return queries @ candidates.T  # sums may wrap on the way, not at the end


def _cell(queries: pd.DataFrame, candidates: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores, which of them count, and the candidates' ids, in id order (null last)."""
    ids = np.array([NO_ID if pd.isna(x) else int(x) for x in candidates["id"].astype(object)], dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    width = max([1, *map(len, queries["v"]), *map(len, candidates["v"])])
    scores = _products(_matrix(list(queries["v"]), width), _matrix(list(candidates["v"].iloc[order]), width))
    return scores, queries["id"].to_numpy(dtype=np.int64)[:, None] != ids[None, :], ids


def _grid(queries: DataFrame, candidates: DataFrame, n_q: int, n_c: int):
    """Both sides, dealt to the cells of the grid, for a cogroup on (q, c)."""
    left = queries.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    right = candidates.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    return left.groupBy("q", "c").cogroup(right.groupBy("q", "c"))


def _frame(names: list[str], parts: list[tuple]) -> pd.DataFrame:
    """Rows of (a query's id, its array, another array) triples."""
    if not parts:
        return pd.DataFrame({n: pd.Series([], dtype="int64") for n in names})
    ids, first, second = zip(*parts)
    return pd.DataFrame(dict(zip(names, (np.repeat(ids, [len(x) for x in first]), np.concatenate(first), np.concatenate(second)))))


def _count(k: int):
    """Each query's scores in this cell by bin, from its kth score here up; bin BINS is above the window."""
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            scores, real, _ = _cell(queries, candidates)
            low, step = queries["low"].to_numpy(dtype=np.int64), queries["step"].to_numpy(dtype=np.int64)
            bins = np.where(real, np.clip((scores - low[:, None]) // step[:, None], -1, BINS), -1)
            for query, row in zip(queries["id"], bins):
                n = np.bincount(row + 1, minlength=BINS + 2)[1:]
                kth = int(np.searchsorted(np.cumsum(n[::-1]), k))
                full = np.nonzero(n)[0]
                full = full[full >= BINS - kth]
                out.append((query, full, n[full]))
        return _frame(["id", "bin", "n"], out)
    return run


def _pick(k: int):
    """Each query's scores above its kth value, and this cell's smallest ids with just that value."""
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            scores, real, ids = _cell(queries, candidates)
            for query, low, row, counts in zip(queries["id"], queries["low"], scores, real):
                at = np.concatenate([np.nonzero(counts & (row > low))[0], np.nonzero(counts & (row == low))[0][:k]])
                out.append((query, ids[at], row[at]))
        return _frame(["query_id", "vec_id", "score"], out)
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` best rows of ``vectors`` for each row that ``is_query`` names:
    ``query_id, rank, vec_id, score``. Fewer rows where there are fewer candidates."""
    flag = free_name(vectors, "asks")
    rows = vectors.withColumn(flag, F.coalesce(is_query, F.lit(False))).where(usable(F.col(vector_col)))
    rows = materialize(rows.select(F.col(id_col).alias("id"), scaled(F.col(vector_col), scale).alias("v"), F.col(flag).alias("asks"), F.monotonically_increasing_id().alias("row")), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    queries = rows.where("asks and id is not null").groupBy("id").agg(F.min("v").alias("v")).withColumn("norm", norm)
    n, n_queries, largest, asking = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1)), F.max(norm), F.max(F.when(F.col("asks"), norm))).first()
    if (largest or 0.0) * (asking or 0.0) * 1.00001 >= LARGEST:
        raise ValueError(f"scores may leave 64 bits: norms up to {asking:.3g} of queries and {largest:.3g} of candidates")
    n_q, n_c = max(1, math.ceil(n_queries / QUERY_GROUP)), max(1, math.ceil(n / CANDIDATE_GROUP))
    candidates = rows.select("id", "v", F.floor(unit_hash("row", seed=1) * n_c).cast("int").alias("c"))
    reach = F.ceil(F.col("norm") * float(largest or 0.0) * 1.000001).cast("long") + 1
    step = lambda width: F.greatest(F.lit(1).cast("long"), F.ceil(width / BINS).cast("long"))
    state = queries.select("id", "v", F.floor(unit_hash("id", seed=2) * n_q).cast("int").alias("q"), (-reach).alias("low"), step(2.0 * reach + 1).alias("step"))
    state = materialize(state, "queries")
    width = state.agg(F.max("step")).first()[0]
    while width:
        counts = _grid(state, candidates, n_q, n_c).applyInPandas(_count(k), "id long, bin int, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("id").orderBy(F.desc("bin")))
        # The kth score's bin; with fewer than k scores the lowest one, so that all are in it or above.
        kth = (counts.withColumn("above", above).groupBy("id")
               .agg(F.coalesce(F.max(F.when(F.col("above") >= k, F.col("bin"))), F.min("bin")).alias("bin")))
        low = F.col("low") + F.coalesce(F.col("bin"), F.lit(0)) * F.col("step")
        state = materialize(state.join(kth, "id", "left").select("id", "v", "q", low.alias("low"), step(F.col("step")).alias("step")), "windows")
        width = state.agg(F.max("step")).first()[0] if width > 1 else 0  # bins one score wide: low is the kth value
    found = _grid(state, candidates, n_q, n_c).applyInPandas(_pick(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return (found.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
            .withColumn("vec_id", F.when(F.col("vec_id") != NO_ID, F.col("vec_id"))))
